"""Cleaned workforce feeds and the rows their deduplication sets aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import payroll_usd_rate
from ledgerlane.functions.groups import dealt, first_per_group, losers

# Columns that make two employment records the same event.
SAME_RECORD = ["person_id", "department_id", "hire_date", "employment_status"]
SAME_RUN = ["employee_id", "pay_period"]
SAME_REVIEW = ["employee_id", "review_period"]


def departments(raw: DataFrame) -> DataFrame:
    return raw.select("department_id", "department_code", "department_name", "division", "cost_center")


def employees(raw: DataFrame) -> DataFrame:
    """Employment records without double inserts; the lowest employee_id stays."""
    kept = first_per_group(raw, SAME_RECORD, [F.col("employee_id").asc()])
    return kept.selectExpr(
        "employee_id",
        "person_id",
        "full_name",
        "department_id",
        "job_level",
        "employment_type",
        "location",
        "cast(hire_date as date) as hire_date",
        "cast(termination_date as date) as termination_date",
        "employment_status",
        "prior_employee_id",
        """coalesce(employment_status = 'terminated' and termination_date is null, false)
           as is_missing_termination_date""",
        "false as is_duplicate_record",
    )


def _paid(runs: DataFrame, *extra: str) -> DataFrame:
    return runs.selectExpr(
        "payroll_id",
        "employee_id",
        "person_id",
        "cast(pay_period as date) as pay_period",
        "gross_pay",
        "currency",
        f"gross_pay * {payroll_usd_rate()} as gross_pay_usd",
        "is_partial_period",
        "paid_at",
        *extra,
    )


def payroll(raw: DataFrame, bucketed: bool = False) -> DataFrame:
    """The last run of each employee and period; a reissue with the same time wins by id.

    Runs are dealt by employee, so joins on the employee need no other shuffle of payroll; ``bucketed`` says that
    they are stored so."""
    order = [F.col("paid_at").desc_nulls_last(), F.col("payroll_id").desc()]
    parts = [raw] if bucketed else dealt(raw, "employee_id")
    kept = [first_per_group(part, SAME_RUN, order, repeat_flag="has_reissued_payroll") for part in parts]
    return _paid(reduce(DataFrame.unionByName, kept), "has_reissued_payroll").withColumn("is_cancelled_run", F.lit(False))


def cancelled_payroll(raw: DataFrame) -> DataFrame:
    """Runs replaced by a reissue, with the run that replaced them."""
    latest = F.max(F.struct("paid_at", "payroll_id"))
    return _paid(losers(raw, SAME_RUN, "payroll_id", latest, "kept_payroll_id"), "kept_payroll_id")


def performance_reviews(raw: DataFrame) -> DataFrame:
    """The last dated submission of each employee and cycle; undated ones only as a last resort."""
    order = [F.col("review_date").desc_nulls_last(), F.col("review_id").desc()]
    kept = first_per_group(raw, SAME_REVIEW, order)
    return kept.selectExpr(
        "review_id",
        "employee_id",
        "person_id",
        "review_period",
        "rating",
        "review_score",
        "reviewer_id",
        "cast(review_date as date) as review_date",
        "review_date is null as is_missing_review_date",
        "false as is_duplicate_submission",
    )


def dropped_records(raw_employees: DataFrame) -> DataFrame:
    """Double-inserted employment records and the record that stands for them."""
    lowest = F.min(F.struct("employee_id"))
    return losers(raw_employees, SAME_RECORD, "employee_id", lowest, "kept_employee_id")


def dedup_audit(raw_employees: DataFrame, raw_reviews: DataFrame) -> DataFrame:
    """Every employment record and review submission that deduplication left out."""
    latest = F.max(F.struct("review_date", "review_id"))
    reviews = losers(raw_reviews, SAME_REVIEW, "review_id", latest, "kept_id").select(
        F.lit("performance_review").alias("entity"),
        F.col("review_id").alias("discarded_id"),
        "kept_id",
        "person_id",
    )
    records = dropped_records(raw_employees).select(
        F.lit("employment_record").alias("entity"),
        F.col("employee_id").alias("discarded_id"),
        F.col("kept_employee_id").alias("kept_id"),
        "person_id",
    )
    return records.unionByName(reviews)


def payroll_monthly(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    """Payroll of known records with their department; pay of dropped duplicates is left out."""
    home = employees.select("employee_id", "department_id")
    return payroll.join(home, "employee_id").selectExpr(
        "payroll_id",
        "employee_id",
        "person_id",
        "department_id",
        "pay_period",
        "trunc(pay_period, 'MM') as pay_month",
        "gross_pay",
        "currency",
        "gross_pay_usd",
        "is_partial_period",
        "paid_at",
    )


def reassigned_payroll(
    payroll: DataFrame, dropped: DataFrame, employees: DataFrame, keep_unknown: bool = False
) -> DataFrame:
    """Payroll with the pay of dropped duplicates moved to the record that was kept.

    Every record id, kept or dropped, maps to the record that counts. A duplicate shares the
    department of the record it repeats, so payroll meets the small side once, on employee_id. Pay of
    a record nobody knows is left out, or kept without a record and department if ``keep_unknown``.
    """
    kept = employees.selectExpr("employee_id as paid_employee_id", "employee_id", "department_id", "false as is_reassigned")
    moved = dropped.selectExpr(
        "employee_id as paid_employee_id", "kept_employee_id as employee_id", "department_id", "true as is_reassigned"
    )
    return (
        payroll.withColumnRenamed("employee_id", "paid_employee_id")
        .join(kept.unionByName(moved), "paid_employee_id", "left" if keep_unknown else "inner")
        .selectExpr(
            "payroll_id",
            "paid_employee_id",
            "employee_id",
            "person_id",
            "department_id",
            "trunc(pay_period, 'MM') as pay_month",
            "gross_pay",
            "currency",
            "gross_pay_usd",
            "is_reassigned",
        )
    )


def inferred_terminations(employees: DataFrame, payroll: DataFrame) -> DataFrame:
    """An end date for records that are terminated without one.

    The last paid period stands in; a record that was never paid gets the day after hire and
    goes to manual review.
    """
    undated = employees.where("is_missing_termination_date")
    last_paid = (
        payroll.join(undated.select("employee_id"), "employee_id", "left_semi")
        .groupBy("employee_id")
        .agg(F.max(F.col("pay_period").cast("date")).alias("last_pay_period"))
    )
    paid = F.col("last_pay_period")
    return undated.join(last_paid, "employee_id", "left").select(
        "employee_id",
        "person_id",
        "hire_date",
        "last_pay_period",
        F.coalesce(paid, F.date_add("hire_date", 1)).alias("inferred_termination_date"),
        F.when(paid.isNotNull(), "last_pay_period").otherwise("day_after_hire").alias("inferred_from"),
        paid.isNull().alias("needs_manual_review"),
    )


def with_inferred_terminations(employees: DataFrame, inferred: DataFrame) -> DataFrame:
    """Employment records with the inferred end dates filled in."""
    dates = inferred.select("employee_id", "inferred_termination_date")
    return (
        employees.join(dates, "employee_id", "left")
        .withColumn("termination_date", F.coalesce("termination_date", "inferred_termination_date"))
        .select(employees.columns)
    )
