"""Sets of ranges over whole numbers or days, without a row per number or day.

A range covers ``lo`` to ``hi``, both included. Windows run over the ranges of one key, or over the
distinct ends of its ranges, never over the numbers that they cover.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def islands(points: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The runs of neighbouring numbers among the distinct ``at`` of each key, as (keys, lo, hi)."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(at))
    return (
        points.select(*keys, at)
        .distinct()
        .withColumn("_run", F.col(at) - place)
        .groupBy(*keys, "_run")
        .agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
        .drop("_run")
    )


def merged(ranges: DataFrame, keys: Sequence[str], gap: int = 0) -> DataFrame:
    """Ranges of dates united where they overlap or where at most ``gap`` days lie between the end of what came
    before and the next start: (keys, lo, hi, and the number of ranges in ``parts``). With a gap of 0 a range that
    starts on the day another ends belongs to it."""
    earlier = W.partitionBy(*keys).orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1)
    so_far = W.partitionBy(*keys).orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, 0)
    apart = F.coalesce(F.date_diff("lo", F.col("_reach")) > gap, F.lit(True))
    return (
        ranges.select(*keys, "lo", "hi")
        .where("lo <= hi")
        .withColumn("_reach", F.max("hi").over(earlier))
        .withColumn("_chain", F.sum(apart.cast("int")).over(so_far))
        .groupBy(*keys, "_chain")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("parts"))
        .drop("_chain")
    )


def in_one_only(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What only one of two sets of ranges (keys, lo, hi) covers: (keys, lo, hi, in_first), each range as long as can be.

    Every range becomes +1 at its start and -1 after its end; between two neighbouring ends of a key the
    sums say which of the sets cover.
    """

    def steps(ranges: DataFrame, a: int, b: int) -> DataFrame:
        ends = f"inline(array(struct(lo as at, {a} as a, {b} as b), struct(hi + 1 as at, -{a} as a, -{b} as b)))"
        return ranges.selectExpr(*keys, ends)

    ordered = W.partitionBy(*keys).orderBy("at")
    running = ordered.rowsBetween(W.unboundedPreceding, 0)
    changes = (
        steps(first, 1, 0)
        .union(steps(second, 0, 1))
        .groupBy(*keys, "at")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .where("a <> 0 or b <> 0")
    )
    covered = changes.select(
        *keys, "at", (F.sum("a").over(running) > 0).alias("in_first"), (F.sum("b").over(running) > 0).alias("_in_second")
    )
    state = F.struct("in_first", "_in_second")
    turned = covered.withColumn("_before", F.lag(state).over(ordered)).where(~state.eqNullSafe(F.col("_before")))
    return (
        turned.select(*keys, F.col("at").alias("lo"), (F.lead("at").over(ordered) - 1).alias("hi"), "in_first", "_in_second")
        .where(F.col("in_first") != F.col("_in_second"))
        .drop("_in_second")
    )
