"""Person-grain employment history and the workforce fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import payroll_usd_rate, years
from ledgerlane.functions.groups import first_per_group


def person_history(spans: DataFrame, as_of: date) -> DataFrame:
    """One row per person: current assignment and three ways to measure tenure."""
    today = F.lit(as_of)
    open_stint = F.col("is_active_stint") == 1
    worked = F.date_diff(F.coalesce("stint_end_date", today), F.col("stint_start_date")).cast("bigint")
    merged = spans.groupBy("person_id").agg(
        F.max("full_name").alias("full_name"),
        F.max("is_active_stint").alias("is_currently_active"),
        F.count("*").alias("total_stints"),
        F.min("stint_start_date").alias("first_hire_date"),
        F.max("stint_end_date").alias("last_termination_date"),
        F.max(F.when(open_stint, F.col("stint_start_date"))).alias("current_stint_start_date"),
        F.sum("transfers_in_stint").alias("total_transfers"),
        F.sum(worked).alias("tenure_total_service_days"),
        F.max("assignment").alias("assignment"),
    )
    active = F.col("is_currently_active") == 1
    until = F.when(active, today).otherwise(F.col("last_termination_date"))
    return (
        merged.withColumns(
            {
                **{
                    f"current_{name}": F.col(f"assignment.{name}")
                    for name in ("employee_id", "department_id", "job_level", "employment_type", "location")
                },
                "tenure_current_stint_days": F.when(
                    active, F.date_diff(today, F.col("current_stint_start_date")).cast("bigint")
                ),
                "tenure_continuous_days": F.date_diff(until, F.col("first_hire_date")).cast("bigint"),
                "is_rehire": F.col("total_stints") > 1,
                "has_transferred": F.col("total_transfers") > 0,
            }
        )
        .withColumns(
            {
                "tenure_total_service_years": years("tenure_total_service_days"),
                "tenure_current_stint_years": years("tenure_current_stint_days"),
            }
        )
        .drop("assignment")
    )


def _latest_pay(raw_payroll: DataFrame, employees: DataFrame) -> DataFrame:
    """Last pay of each person, by period, then record, then time of payment and run.

    The last run of a record's last period is also what period deduplication would keep. Each record's
    last period comes from a hash aggregate over the feed; only the runs of a person's last record
    and period are then looked at. Runs without a period are nobody's last pay.
    """
    runs = raw_payroll.withColumn("pay_period", F.col("pay_period").cast("date"))
    per_record = runs.groupBy("person_id", "employee_id").agg(F.max("pay_period").alias("pay_period"))
    known = per_record.join(employees.select("employee_id"), "employee_id", "left_semi")
    last = known.groupBy("person_id").agg(F.max(F.struct("pay_period", "employee_id")).alias("last"))
    of_last = runs.join(last.select("person_id", "last.*"), ["person_id", "employee_id", "pay_period"])
    final = F.max(F.struct("paid_at", "payroll_id", "gross_pay", "currency"))
    return (
        of_last.groupBy("person_id")
        .agg(final.alias("pay"))
        .selectExpr(
            "person_id",
            f"pay.gross_pay * {payroll_usd_rate('pay.currency')} as latest_monthly_pay_usd",
            "pay.gross_pay as latest_monthly_pay_local",
            "pay.currency as pay_currency",
        )
    )


def _latest_review(raw_reviews: DataFrame) -> DataFrame:
    """Last review of each person; the overall last one is last within its own cycle too.

    The last cycle comes from a hash aggregate over the feed; only its reviews are ranked. A review
    without a cycle is nobody's last one.
    """
    last = raw_reviews.groupBy("person_id").agg(F.max("review_period").alias("review_period"))
    order = [F.col("review_date").desc_nulls_last(), F.col("review_id").desc()]
    return first_per_group(raw_reviews.join(last, ["person_id", "review_period"]), ["person_id"], order).select(
        "person_id",
        F.col("rating").alias("latest_rating"),
        F.col("review_score").alias("latest_review_score"),
        F.col("review_period").alias("latest_review_period"),
    )


def workforce_fact(
    history: DataFrame, departments: DataFrame, employees: DataFrame, raw_payroll: DataFrame, raw_reviews: DataFrame
) -> DataFrame:
    """One row per person who was ever employed."""
    home = departments.select(
        F.col("department_id").alias("current_department_id"),
        F.col("department_name").alias("current_department_name"),
        F.col("division").alias("current_division"),
        F.col("cost_center").alias("current_cost_center"),
    )
    return (
        history.join(_latest_pay(raw_payroll, employees), "person_id", "left")
        .join(_latest_review(raw_reviews), "person_id", "left")
        .join(home, "current_department_id", "left")
        .withColumn("tenure_continuous_years", years("tenure_continuous_days"))
        .withColumn("annualized_pay_usd", F.col("latest_monthly_pay_usd") * 12)
    )


def department_dimension(departments: DataFrame, history: DataFrame) -> DataFrame:
    active = (
        history.where(F.col("is_currently_active") == 1)
        .groupBy(F.col("current_department_id").alias("department_id"))
        .agg(F.count("*").alias("active_headcount"))
    )
    return departments.join(active, "department_id", "left").select(
        *departments.columns, F.coalesce("active_headcount", F.lit(0)).alias("active_headcount")
    )


def person_summary(history: DataFrame) -> DataFrame:
    """Headline counts and average tenure of the active people."""
    active = F.col("is_currently_active") == 1

    def mean(name: str):
        # Tenths of a year add up exactly as decimals, so the mean does not depend on row order.
        value = F.when(active, F.col(name).cast("decimal(10,1)"))
        return F.round(F.sum(value).cast("double") / F.nullif(F.count(value).cast("double"), F.lit(0.0)), 2)

    return history.agg(
        F.count("*").alias("total_persons"),
        F.count_if(active).alias("active_persons"),
        F.count_if("is_rehire").alias("rehires"),
        F.count_if("has_transferred").alias("has_transferred"),
        mean("tenure_total_service_years").alias("avg_tenure_total_service"),
        mean("tenure_current_stint_years").alias("avg_tenure_current_stint"),
    )


def record_type_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("record_type").agg(
        F.count("*").alias("records"), F.count_distinct("person_id").alias("persons")
    )
