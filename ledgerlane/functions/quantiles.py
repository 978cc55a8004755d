"""Quantiles from counts that can be stored and added up.

A sketch has one row per group and cell, with the number of values in it. A cell holds whole numbers that share
their leading ``bits`` binary digits, and is named by the number in its middle; so numbers below 2^bits have a cell
of their own and no other is further from its cell's name than a share of 1 / 2^bits. Cells do not
depend on the data: sketches of the same bits add up to the sketch of all values, in any order, and a group has
at most some 60 x 2^bits cells, however many values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BITS = 7


def sketch(values: DataFrame, keys: Sequence[str], value: str, bits: int = BITS) -> DataFrame:
    """Counts per group and cell of the whole numbers in ``value``; nulls do not count."""
    size = f"abs(cast({value} as bigint))"
    width = f"shiftleft(1L, greatest(length(bin({size})) - {bits}, 0))"
    middle = f"({size} - {size} % {width} + ({width} - 1) div 2)"
    return (
        values.where(f"{value} is not null")
        .groupBy(*keys, F.expr(f"if({value} < 0, -{middle}, {middle})").alias("cell"))
        .agg(F.count("*").alias("n"))
    )


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketch of coarser groups, or of several sketches' rows together."""
    return sketches.groupBy(*keys, "cell").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: Sequence[str], percents: dict[str, int]) -> DataFrame:
    """Per group the number of values as ``n`` and, under each name, the cell of the smallest value that this percentage
    of all values does not exceed. Windows hold the cells of one group."""
    order = W.partitionBy(*keys).orderBy("cell")
    counted = sketches.withColumn("total", F.sum("n").over(W.partitionBy(*keys))).withColumn(
        "so_far", F.sum("n").over(order.rowsBetween(W.unboundedPreceding, 0))
    )
    chosen = [F.min(F.expr(f"if(so_far * 100 >= total * {p}, cell, null)")).alias(name) for name, p in percents.items()]
    return counted.groupBy(*keys).agg(F.max("total").alias("n"), *chosen)
