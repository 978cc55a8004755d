"""Payroll against employment, record by record."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlane.functions.durable import durable
from ledgerlane.functions.groups import dealt
from ledgerlane.functions.ranges import in_one_only, islands
from ledgerlane.operators.people_attrition import last_month, month_number, month_start

PAID = "paid_not_employed"
EMPLOYED = "employed_not_paid"


def record_map(raw_employees: DataFrame, dropped: DataFrame | None, employees: DataFrame) -> DataFrame:
    """Every record id as it may stand in payroll: its own department, the record that counts, and that one's
    department. Without ``dropped`` every record counts for itself, and a dropped one has no department.

    The records are merged: Spark would broadcast written ones by their compressed bytes, a small part of what every
    task then holds."""
    own = raw_employees.select("employee_id", F.col("department_id").alias("own_department_id"))
    kept = employees.select(F.col("employee_id").alias("record_id"), "department_id")
    if dropped is None:
        own = own.withColumn("record_id", F.col("employee_id"))
    else:
        replaced = dropped.select("employee_id", "kept_employee_id")
        own = own.join(replaced, "employee_id", "left").withColumn("record_id", F.coalesce("kept_employee_id", "employee_id"))
    return own.select("employee_id", "own_department_id", "record_id").join(kept.hint("merge"), "record_id", "left")


def paid_months(payroll: DataFrame, records: DataFrame) -> DataFrame:
    """Deduplicated payroll per record that counts and month, with both departments.

    Pay of a dropped duplicate belongs to the kept record; a record that nobody knows keeps its own id and
    has no department. Pay without a period has a null month. The runs are written with their records, because
    dealing them by record counts them first.
    """
    runs = (
        payroll.select("employee_id", F.expr(f"{month_number('pay_period')} as month_no"), "gross_pay_usd")
        .join(records, "employee_id", "left")
        .select(F.coalesce("record_id", "employee_id").alias("record_id"), "department_id", "own_department_id", "month_no", "gross_pay_usd")
    )
    months = [
        part.groupBy("record_id", "department_id", "own_department_id", "month_no").agg(
            F.count("*").alias("pay_runs"), F.sum("gross_pay_usd").alias("usd")
        )
        for part in dealt(durable(runs, "paid-runs"), "record_id")
    ]
    return reduce(DataFrame.unionByName, months)


def employed_months(employees: DataFrame, as_of: date) -> DataFrame:
    """(record_id, department_id, lo, hi): the months of each record up to ``as_of``. A record without a hire date, or
    that ended before it began, is never employed."""
    ends = f"least({month_number(f'coalesce(termination_date, date\'{as_of}\')')}, {last_month(as_of)})"
    return (
        employees.where("hire_date is not null")
        .selectExpr("employee_id as record_id", "department_id", f"{month_number('hire_date')} as lo", f"{ends} as hi")
        .where("lo <= hi")
    )


def pay_employment_gaps(paid: DataFrame, employees: DataFrame, as_of: date) -> DataFrame:
    """Every range of months in which a record is paid but not employed, or employed but not paid.

    The paid months of a record become islands and are set against its months of employment; both sides are
    a handful of ranges per record, whatever they span. The records are merged, as in ``record_map``.
    """
    key = ["record_id"]
    months = dealt(paid.where("month_no is not null"), "record_id")
    runs = reduce(DataFrame.unionByName, [islands(part, key, "month_no") for part in months])
    homes = employees.select(F.col("employee_id").alias("record_id"), "person_id", "department_id")
    return (
        in_one_only(runs, employed_months(employees, as_of), key)
        .join(homes.hint("merge"), "record_id", "left")
        .select(
            F.col("record_id").alias("employee_id"),
            "person_id",
            "department_id",
            F.when(F.col("in_first"), PAID).otherwise(EMPLOYED).alias("kind"),
            F.expr(f"{month_start('lo')} as first_month"),
            F.expr(f"{month_start('hi')} as last_month"),
            (F.col("hi") - F.col("lo") + 1).cast("bigint").alias("months"),
        )
    )


def _records_per_month(ranges: DataFrame, kinds: list[str]) -> DataFrame:
    """How many ranges (department_id, kind, lo, hi) of each kind cover a month, per department, from its first
    covered month to its last. One +1 and one -1 per range, then a running sum over months."""
    changes = (
        ranges.selectExpr(
            "department_id", "kind",
            "inline(array(struct(lo as month_no, 1 as step), struct(hi + 1 as month_no, -1 as step)))",
        )
        .groupBy("department_id", "month_no")
        .agg(*[F.sum(F.when(F.col("kind") == kind, F.col("step")).otherwise(0)).alias(kind) for kind in kinds])
    )
    none = ", ".join(f"0 as {kind}" for kind in kinds)
    calendar = (
        changes.groupBy("department_id")
        .agg(F.min("month_no").alias("first"), F.max("month_no").alias("after"))
        .selectExpr("department_id", f"inline(transform(sequence(first, after), m -> struct(m as month_no, {none})))")
    )
    running = W.partitionBy("department_id").orderBy("month_no").rowsBetween(W.unboundedPreceding, 0)
    return (
        calendar.unionByName(changes)
        .groupBy("department_id", "month_no")
        .agg(*[F.sum(kind).alias(kind) for kind in kinds])
        .select("department_id", "month_no", *[F.sum(kind).over(running).alias(kind) for kind in kinds])
    )


def payroll_cost_tieout(
    paid: DataFrame, gaps: DataFrame, employees: DataFrame, departments: DataFrame, as_of: date
) -> DataFrame:
    """Payroll per month and department next to the records employed, and next to the staged pay.

    Takes ``paid_months`` and ``pay_employment_gaps``, written, as both are read twice. ``payroll_usd`` has the pay of
    dropped duplicates with the kept record, ``staged_usd`` the same payroll by the department of the paid record
    itself. A month ties out when every employed record is paid, no other one is, and both amounts agree; the
    numbers of records that fail this are stated, so errors that offset each other do not hide. Pay outside the
    months of employment, of a department that is not listed, or of an unknown record (department null) has rows
    of its own, so the amounts add up to all of the staged payroll.
    """
    nothing, amount = "cast(0 as decimal(38,4))", "cast(usd as decimal(38,4))"
    pay = (
        paid.selectExpr(
            "month_no",
            f"""inline(array(
                  struct(department_id, pay_runs, 1L as paid_records, {amount} as payroll_usd, {nothing} as staged_usd),
                  struct(own_department_id as department_id, 0L as pay_runs, 0L as paid_records, {nothing} as payroll_usd,
                         {amount} as staged_usd)))""",
        )
        .groupBy("department_id", "month_no")
        .agg(*[F.sum(name).alias(name) for name in ("pay_runs", "paid_records", "payroll_usd", "staged_usd")])
    )
    first, last = (month_number(f"{end}_month") for end in ("first", "last"))
    spans = employed_months(employees, as_of).selectExpr("department_id", "'employed_records' as kind", "lo", "hi").union(
        gaps.selectExpr("department_id", "kind", f"{first} as lo", f"{last} as hi")
    )
    kinds = ["employed_records", PAID, EMPLOYED]
    measures = ["employed_records", "pay_runs", "paid_records", "payroll_usd", "staged_usd", PAID, EMPLOYED]
    together = _records_per_month(spans, kinds).unionByName(pay, allowMissingColumns=True)
    return (
        together.groupBy("department_id", "month_no")
        .agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in measures])
        .where("employed_records > 0 or pay_runs > 0 or staged_usd <> 0")
        .join(departments.select("department_id", "department_name"), "department_id", "left")
        .select(
            "department_id",
            "department_name",
            F.expr(f"{month_start('month_no')} as pay_month"),
            *measures,
            F.expr("paid_records - employed_records as record_difference"),
            F.expr("payroll_usd - staged_usd as usd_difference"),
            F.expr(
                f"{PAID} = 0 and {EMPLOYED} = 0 and paid_records = employed_records and payroll_usd = staged_usd as ties_out"
            ),
        )
    )
