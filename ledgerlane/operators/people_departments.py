"""Department reporting: movements, tenure and payroll cost."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import DAYS_PER_YEAR, month_of, percent, ratio
from ledgerlane.operators.people_bridge import trailing_year
from ledgerlane.operators.people_stints import REHIRE, TRANSFER


def _mean(total: Column, count: Column) -> Column:
    return total.cast("double") / F.nullif(count.cast("double"), F.lit(0.0))


def department_movements(records: DataFrame, history: DataFrame, departments: DataFrame) -> DataFrame:
    """Headcount and trailing-year movements by department, division and company.

    A linked transfer leaves its old department and enters the new one on the same day, so the
    two columns have equal sums; a transfer without a successor record is listed on its own. A
    department that is not listed, and records without one, have a row without name and division.
    """
    first, last = trailing_year(records)
    joined_in = F.col("hire_date").between(first, last)
    left_in = F.col("termination_date").between(first, last)
    continues = F.col("record_type") == TRANSFER
    arrivals = records.groupBy("department_id").agg(
        F.count_if(~continues & joined_in).alias("hires"),
        F.count_if((F.col("record_type") == REHIRE) & joined_in).alias("rehires"),
        F.count_if(continues & joined_in).alias("transfers_in"),
        F.count_if((F.col("employment_status") == "terminated") & left_in).alias("exits"),
    )
    successors = records.where(continues).select(
        F.col("prior_employee_id").alias("employee_id"), F.col("hire_date").alias("moved_on")
    )
    departures = (
        records.where(F.col("employment_status") == "transferred")
        .select("employee_id", "department_id", "termination_date")
        .join(successors, "employee_id", "left")
        .groupBy("department_id")
        .agg(
            F.count_if(F.col("moved_on").between(first, last)).alias("transfers_out"),
            F.count_if(F.col("moved_on").isNull() & left_in).alias("unlinked_transfers_out"),
        )
    )
    present = (
        history.where(F.col("is_currently_active") == 1)
        .groupBy(F.col("current_department_id").alias("department_id"))
        .agg(F.count("*").alias("active_headcount"), F.sum("tenure_total_service_days").alias("service_days"))
    )
    measures = [
        "active_headcount",
        "hires",
        "rehires",
        "transfers_in",
        "exits",
        "transfers_out",
        "unlinked_transfers_out",
        "service_days",
    ]
    known = departments.select("division", "department_id", "department_name", "cost_center")
    moved = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), (present, arrivals, departures))
    summed = moved.groupBy("department_id").agg(*[F.sum(name).alias(name) for name in measures])
    per_department = summed.join(known, "department_id", "full")
    level = F.grouping_id()
    one_department = level == 0
    rolled = per_department.rollup("division", "department_id").agg(
        F.when(level == 3, "company").when(level == 1, "division").otherwise("department").alias("level"),
        F.when(one_department, F.min("department_name")).alias("department_name"),
        F.when(one_department, F.min("cost_center")).alias("cost_center"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in measures],
    )
    return rolled.withColumns(
        {
            "net_change": F.col("hires")
            + F.col("transfers_in")
            - F.col("exits")
            - F.col("transfers_out")
            - F.col("unlinked_transfers_out"),
            "attrition_rate_pct": percent("exits", "active_headcount", 2),
            "avg_tenure_total_service_yrs": F.round(
                _mean(F.col("service_days"), F.col("active_headcount")) / DAYS_PER_YEAR, 2
            ),
        }
    ).drop("service_days")


def tenure_by_department(history: DataFrame, departments: DataFrame) -> DataFrame:
    """Three tenure measures of the people active in each department."""
    people = F.count("*")

    def mean_years(name: str) -> Column:
        return F.round(_mean(F.sum(name), people) / DAYS_PER_YEAR, 2)

    active = (
        history.where(F.col("is_currently_active") == 1)
        .groupBy(F.col("current_department_id").alias("department_id"))
        .agg(
            people.alias("active_headcount"),
            mean_years("tenure_total_service_days").alias("avg_total_service_yrs"),
            mean_years("tenure_current_stint_days").alias("avg_current_stint_yrs"),
            mean_years("tenure_continuous_days").alias("avg_continuous_yrs"),
            F.round(F.median("tenure_total_service_years"), 2).alias("median_total_service_yrs"),
        )
    )
    return departments.select("department_id", "department_name", "division", "cost_center").join(
        active, "department_id"
    )


def pay_calendar(payroll: DataFrame) -> tuple[Column, Column]:
    """The first day and the last day of the paid months, as scalar subqueries."""
    return payroll.agg(F.min("pay_period")).scalar(), payroll.agg(F.last_day(F.max("pay_period"))).scalar()


def payroll_monthly_cost(payroll: DataFrame, monthly: DataFrame) -> DataFrame:
    """Deduplicated payroll per month and currency: local, at the fixed rate, at the month's average rate, and
    per head. Dollars need no rate; another currency without quotes has null amounts at the month's rate."""
    # Collapsed to people first, so that counting them needs no distinct aggregate over the runs.
    people = payroll.groupBy(month_of("pay_period").alias("pay_month"), "currency", "person_id").agg(
        F.count("*").alias("runs"), F.sum("gross_pay").alias("local"), F.sum("gross_pay_usd").alias("usd")
    )
    totals = people.groupBy("pay_month", "currency").agg(
        F.sum("runs").alias("pay_runs"),
        F.count("person_id").alias("paid_heads"),
        F.sum("local").alias("gross_local"),
        F.sum("usd").alias("gross_usd_fixed"),
    )
    rates = monthly.select(F.col("rate_month").alias("pay_month"), "currency", "avg_usd_rate")
    priced = totals.join(rates, ["pay_month", "currency"], "left").withColumn(
        "avg_usd_rate", F.expr("if(currency = 'USD', 1.0D, avg_usd_rate)")
    )
    return priced.withColumn("gross_usd", F.expr("round(cast(gross_local as double) * avg_usd_rate, 2)")).withColumns(
        {
            "local_per_head": ratio("gross_local", "paid_heads", 2),
            "usd_per_head": ratio("gross_usd", "paid_heads", 2),
        }
    )
