"""Why Finance and Talent count different exits, and the one-row workforce KPIs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlane.functions.columns import DAYS_PER_YEAR, percent
from ledgerlane.functions.ranges import merged


def trailing_year(records: DataFrame) -> tuple[Column, Column]:
    """The twelve months that end at the latest termination, both days included."""
    last = records.agg(F.max("termination_date")).scalar()
    return F.add_months(last, -12), last


def _events_per_person(records: DataFrame) -> DataFrame:
    """Exit, transfer and rehire events of the trailing year, one row per person."""
    first, last = trailing_year(records)
    ended = F.col("termination_date").between(first, last)
    status = F.col("employment_status")
    rehired = (F.col("record_type") == "rehire_new_stint") & F.col("hire_date").between(first, last)
    return records.groupBy("person_id").agg(
        F.count_if(ended & (status == "terminated")).alias("terminations"),
        F.count_if(ended & (status == "transferred")).alias("transfers"),
        F.count_if(rehired).alias("rehires"),
        F.bool_or(F.coalesce(status == "active", F.lit(False))).alias("is_active"),
    )


def attrition_bridge(records: DataFrame) -> DataFrame:
    """Five ordered lines from Finance's record count to Talent's person count.

    Each person reduces to one row of counts first; the whole bridge is one aggregate over those.
    """
    left = F.col("terminations") > 0
    totals = _events_per_person(records).agg(
        F.sum(F.col("terminations") + F.col("transfers")).alias("finance"),
        F.sum("transfers").alias("transfers"),
        F.count_if(left).alias("reconciled"),
        F.count_if(left & ~F.col("is_active")).alias("talent"),
        F.count_if("is_active").alias("headcount"),
    )

    def rate(name: str) -> Column:
        return percent(name, "headcount", 1)

    none = F.lit(None)
    # Labels and remarks of the bridge.
    lines = [
        ("Finance record-based exits", F.col("finance"), rate("finance"), none),
        (
            "Less: Transfers miscounted as exits",
            -F.col("transfers"),
            none,
            F.lit("Transfers are internal moves, not departures"),
        ),
        ("Reconciled exits (person-level)", F.col("reconciled"), rate("reconciled"), none),
        ("Talent net exits (excludes rehired persons)", F.col("talent"), rate("talent"), none),
        (
            "Difference: rehires whose departure still counts",
            F.col("reconciled") - F.col("talent"),
            none,
            F.lit("Person left in-period; returned later. Exit still counts in the period it occurred."),
        ),
    ]
    rows = [
        F.struct(
            F.lit(label).alias("line_item"),
            value.cast("bigint").alias("value"),
            pct.cast("double").alias("rate_pct"),
            remark.cast("string").alias("adjustment"),
        )
        for label, value, pct, remark in lines
    ]
    return totals.select(F.inline(F.array(*rows)))


def workforce_kpis(records: DataFrame, history: DataFrame) -> DataFrame:
    first, last = trailing_year(records)
    events = _events_per_person(records).agg(
        F.struct(
            F.count_if(F.col("terminations") > 0).alias("exits"),
            F.sum("transfers").alias("transfers"),
            F.count_if(F.col("rehires") > 0).alias("rehires"),
        )
    ).scalar()

    def mean(value: Column) -> Column:
        return F.sum(value).cast("double") / F.nullif(F.count(value).cast("double"), F.lit(0.0))

    tenths = "decimal(10,1)"
    active = history.where(F.col("is_currently_active") == 1).agg(
        F.count("*").alias("active_headcount"),
        F.round(mean(F.col("tenure_total_service_years").cast(tenths)), 2).alias("avg_tenure_total_service_yrs"),
        F.round(mean(F.col("tenure_current_stint_years").cast(tenths)), 2).alias("avg_tenure_current_stint_yrs"),
        F.round(mean(F.col("tenure_continuous_days")) / DAYS_PER_YEAR, 2).alias("avg_tenure_continuous_yrs"),
        # Exact median over tenths of a year: the aggregate holds one counter per distinct tenth.
        F.round(F.median("tenure_total_service_years"), 2).alias("median_tenure_total_service_yrs"),
    )
    return (
        active.withColumn("events", events)
        .select(
            "*",
            F.col("events.exits").alias("true_exits"),
            percent("events.exits", "active_headcount", 2).alias("attrition_rate_pct"),
            F.col("events.transfers").alias("internal_transfers_12m"),
            percent("events.transfers", "active_headcount", 2).alias("internal_mobility_rate_pct"),
            F.col("events.rehires").alias("rehires_12m"),
            percent("events.rehires", "active_headcount", 2).alias("rehire_rate_pct"),
            F.round(
                F.col("avg_tenure_continuous_yrs") - F.col("avg_tenure_current_stint_yrs"), 2
            ).alias("tenure_spread_yrs"),
            first.alias("period_start"),
            last.alias("period_end"),
        )
        .drop("events")
    )


def _lines(totals: DataFrame, lines: list[tuple[str, str]], value: str) -> DataFrame:
    """One row of totals as numbered lines of whole numbers."""
    rows = ", ".join(
        f"struct({i} as line_no, '{label}' as line_item, cast({amount} as bigint) as {value})"
        for i, (label, amount) in enumerate(lines, start=1)
    )
    return totals.selectExpr("*", f"inline(array({rows}))")


def tenure_spread_bridge(records: DataFrame, spans: DataFrame, history: DataFrame, as_of: date) -> DataFrame:
    """Why the tenure clocks of active people differ: what transfers and rehires add, in days and years.

    Starts at the current record and adds the earlier records of the stint, then service before the stint
    and the time away. Service and time away are measured on the stints themselves, overlapping ones
    united, so the lines need not add up to the clock that runs since the first hire; what is missing is
    the residual.
    """
    starts = records.selectExpr("employee_id as current_employee_id", "hire_date as record_start")
    ranges = spans.select(
        "person_id", F.col("stint_start_date").alias("lo"), F.coalesce("stint_end_date", F.lit(as_of)).alias("hi")
    )
    order = W.partitionBy("person_id").orderBy("lo")
    present = history.where("is_currently_active = 1")
    apart = (
        merged(ranges, ["person_id"])
        .withColumn("left_on", F.lag("hi").over(order))
        .join(present.select("person_id", "current_stint_start_date"), "person_id")
        .groupBy("person_id")
        .agg(
            F.expr("sum(greatest(date_diff(least(hi, current_stint_start_date), lo), 0))").alias("before"),
            F.expr("sum(coalesce(date_diff(lo, left_on), 0))").alias("away"),
        )
    )
    totals = present.join(starts, "current_employee_id", "left").join(apart, "person_id", "left").agg(
        F.count("*").alias("heads"),
        F.sum(F.date_diff(F.lit(as_of), F.col("record_start")).cast("bigint")).alias("record"),
        F.sum("tenure_current_stint_days").alias("stint"),
        F.sum("tenure_continuous_days").alias("continuous"),
        F.sum("before").alias("before"),
        F.sum("away").alias("away"),
    )
    lines = [
        ("Clock since the current record", "record"),
        ("Add: earlier records of the stint (transfers)", "stint - record"),
        ("Clock since the start of the stint", "stint"),
        ("Add: service before the stint, each day once", "before"),
        ("Add: time away before a rehire", "away"),
        ("Unexplained residual", "continuous - stint - before - away"),
        ("Clock since the first hire", "continuous"),
        ("Spread between the two clocks", "continuous - stint"),
    ]
    average = F.round(F.col("total_days").cast("double") / F.nullif("heads", F.lit(0)) / DAYS_PER_YEAR, 2)
    return _lines(totals, lines, "total_days").select("line_no", "line_item", "total_days", average.alias("avg_years"))


def duplicate_bridge(raw_employees: DataFrame, dropped: DataFrame, staged: DataFrame) -> DataFrame:
    """How many exits of the trailing year, and how many heads, are duplicate records."""
    first, last = trailing_year(staged)
    leaves = F.col("employment_status").isin("terminated", "transferred")
    gone = leaves & F.col("termination_date").cast("date").between(first, last)

    def counted(rows: DataFrame, prefix: str):
        return rows.agg(
            F.struct(
                F.count_if(gone).alias("exits"), F.count_if(F.col("employment_status") == "active").alias("heads")
            )
        ).scalar().alias(prefix)

    one = staged.sparkSession.range(1)
    totals = one.select(counted(raw_employees, "raw"), counted(dropped, "twice"), counted(staged, "kept"))
    lines = [
        (f"{title}: {label}", amount)
        for title, name in (("Exits", "exits"), ("Heads", "heads"))
        for label, amount in (
            ("records as loaded", f"raw.{name}"),
            ("less duplicate records", f"-twice.{name}"),
            ("unexplained", f"kept.{name} - raw.{name} + twice.{name}"),
            ("records after deduplication", f"kept.{name}"),
        )
    ]
    return _lines(totals, lines, "records").select("line_no", "line_item", "records")
