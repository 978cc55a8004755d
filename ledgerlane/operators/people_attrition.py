"""Monthly attrition series, as the models define it and by the standard definition."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlane.functions.columns import percent



def last_month(as_of: date) -> int:
    """The month of ``as_of`` as a number: months since year 0."""
    return as_of.year * 12 + as_of.month - 1


def month_number(day: str) -> str:
    """The month of ``day`` as a number, as SQL text."""
    return f"(year({day}) * 12 + month({day}) - 1)"


def month_start(number: str) -> str:
    """The first day of a numbered month, as SQL text."""
    return f"make_date(cast({number} div 12 as int), cast({number} % 12 + 1 as int), 1)"


def _series(spans: DataFrame, last: int, before: int = 0) -> DataFrame:
    """Months from the earliest stint start, or ``before`` months earlier, to ``last``; one row per calendar month."""
    first = f"min({month_number('stint_start_date')}) - {before}"
    return (
        spans.selectExpr(f"{first} as first")
        .where(F.col("first") <= last)
        .selectExpr(f"explode(sequence(first, {last})) as month_no")
        .selectExpr("month_no", f"{month_start('month_no')} as month_start")
    )


def _people_per_month(ranges: DataFrame, series: DataFrame, name: str) -> DataFrame:
    """Distinct people in each month, from the months (person_id, lo, hi) that rows cover.

    A range becomes +1 where it starts to add presence and -1 after it ends, instead of a row per
    month. Overlapping ranges of one person must not count twice, so each only adds the months
    beyond those already covered by the person's earlier ones. Distinct month ranges bound what
    one person can bring to that window, however many rows they have.
    """
    earlier = W.partitionBy("person_id").orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1)
    changes = (
        ranges.where("lo <= hi")
        .distinct()
        .withColumn("covered", F.max("hi").over(earlier))
        .selectExpr("greatest(lo, coalesce(covered + 1, lo)) as lo", "hi")
        .where("lo <= hi")
        .selectExpr("inline(array(struct(lo as month_no, 1 as step), struct(hi + 1 as month_no, -1 as step)))")
        .groupBy("month_no")
        .agg(F.sum("step").alias("change"))
    )
    # Changes before the first month of the series count in it. At most one row per calendar month from here.
    months = series.select("month_no", "month_start").join(changes, "month_no", "full")
    running = W.orderBy("month_no").rowsBetween(W.unboundedPreceding, 0)
    return (
        months.withColumn(name, F.sum(F.expr("coalesce(change, 0)")).over(running))
        .where("month_start is not null")
        .drop("change")
    )


def _headcount(spans: DataFrame, series: DataFrame, first: str, final: str) -> DataFrame:
    """People present per month. A stint without a start date is never present."""
    ranges = spans.where("stint_start_date is not null").selectExpr("person_id", f"{first} as lo", f"{final} as hi")
    return _people_per_month(ranges, series, "headcount")


def _movements(spans: DataFrame) -> DataFrame:
    """Stints started and ended, and people's first starts, per month."""
    starts, ends = month_number("stint_start_date"), month_number("stint_end_date")
    stints = spans.selectExpr(
        f"inline(array(struct({starts} as month_no, 1 as hires, 0 as firsts, 0 as exits), struct({ends} as month_no, 0 as hires, 0 as firsts, 1 as exits)))"
    )
    firsts = (
        spans.groupBy("person_id")
        .agg(F.min("stint_start_date").alias("day"))
        .selectExpr(f"{month_number('day')} as month_no", "0 as hires", "1 as firsts", "0 as exits")
    )
    return (
        stints.unionByName(firsts)
        .where("month_no is not null")
        .groupBy("month_no")
        .agg(
            F.expr("sum(hires) as hires"),
            F.expr("sum(hires) - sum(firsts) as rehires"),
            F.expr("sum(exits) as exits"),
        )
    )


def attrition_monthly(spans: DataFrame, as_of: date) -> DataFrame:
    """Hires, exits, headcount and trailing rates per month.

    Someone is in a month's headcount when they start no later than the first of the next month
    and have not left by the first of the month.
    """

    def shifted(day: str) -> str:
        return f"{month_number(day)} - if(dayofmonth({day}) = 1, 1, 0)"

    last = last_month(as_of)
    headcount = _headcount(
        spans, _series(spans, last), shifted("stint_start_date"), f"coalesce({shifted('stint_end_date')}, {last})"
    )
    monthly = (
        headcount.where("headcount > 0")
        .join(_movements(spans), "month_no", "left")
        .selectExpr(
            "month_start",
            "headcount as active_headcount_eom",
            *[f"coalesce({name}, 0) as {name}" for name in ("hires", "rehires", "exits")],
        )
    )
    # At most one row per calendar month from here on.
    trailing = W.orderBy("month_start").rowsBetween(-11, 0)
    return (
        monthly.withColumns(
            {
                "exits_trailing_12m": F.sum("exits").over(trailing),
                "mean_headcount": F.avg("active_headcount_eom").over(trailing),
            }
        )
        .withColumns(
            {
                "attrition_rate_trailing_12m": percent("exits_trailing_12m", "mean_headcount", 2),
                "attrition_rate_annualized": F.expr(
                    "round(cast(exits as double) / nullif(active_headcount_eom, 0) * 12 * 100, 2)"
                ),
            }
        )
        .drop("mean_headcount")
        .orderBy("month_start")
    )


def attrition_standard(spans: DataFrame, as_of: date) -> DataFrame:
    """People who left within twelve months over the mean of the headcounts that open and close them.

    Headcounts are snapshots at the end of a month: a stint is present from the month it starts
    to the month before it ends. Someone who left several times within a window counts once, like
    in the headcounts. The month before the series opens its first window.
    """
    last = last_month(as_of)
    starts, ends = month_number("stint_start_date"), month_number("stint_end_date")
    series = _series(spans, last, before=1)
    # An exit counts in the windows that end in its month and in the eleven months after it.
    exits = spans.selectExpr("person_id", f"{ends} as lo", f"{ends} + 11 as hi")
    along = W.orderBy("month_start")
    return (
        _headcount(spans, series, starts, f"coalesce({ends} - 1, {last})")
        .join(_people_per_month(exits, series, "exits_12m").drop("month_start"), "month_no")
        .withColumn("opening_headcount", F.lag("headcount", 12).over(along))
        .where("opening_headcount is not null")
        .select(
            "month_start",
            "opening_headcount",
            F.col("headcount").alias("closing_headcount"),
            "exits_12m",
            percent("(exits_12m * 2)", "(opening_headcount + headcount)", 2).alias("attrition_rate_pct"),
        )
    )
