"""Per-group operations that hold up when one group has a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows that one task sorts or hashes of a table that is dealt out.
ROWS_A_TASK = 500_000
#: Hash values of a key that rows are counted by before they are dealt out. Of some 30 billion rows every value has too many.
KEY_HASHES = 1 << 16


def dealt(df: DataFrame, key: str) -> list[DataFrame]:
    """The rows in parts; all rows of one key are in the same part, and in the first part in the same task.

    A shuffle of Spark's own is made up of tasks by its compressed bytes and the number of cores, so the rows of
    one task grow with the table. Here their number decides over how many tasks they are dealt. Rows of keys that are
    too frequent for one task come apart and as they are, so group limits and partial aggregates still reduce them
    before they are shuffled. A table that one task can hold stays as it is.
    """
    place = F.pmod(F.xxhash64(key), F.lit(KEY_HASHES))
    many = F.col("n") > ROWS_A_TASK
    seen = (
        df.groupBy(place.alias("place"))
        .agg(F.count("*").alias("n"))
        .agg(F.sum("n").alias("n"), F.sum(F.when(many, F.col("n"))).alias("apart"), F.collect_list(F.when(many, F.col("place"))).alias("places"))
        .first()
    )
    if (seen.n or 0) <= ROWS_A_TASK:
        return [df]
    # Of fewer tasks than a shuffle of Spark's own has, a join would deal the rows anew.
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-(seen.n - (seen.apart or 0)) // ROWS_A_TASK))
    if not seen.places:
        return [df.repartition(tasks, key)]
    frequent = place.isin(seen.places)
    return [df.where(~frequent).repartition(tasks, key), df.where(frequent)]


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], repeat_flag: str | None = None
) -> DataFrame:
    """First row of every group under a total order.

    The rank filter becomes a group limit on both sides of the shuffle, so a map task sends at most
    one row per group (two when ``repeat_flag`` asks whether the group had more than one).
    """
    kept = 1 if repeat_flag is None else 2
    ranked = df.withColumn("_position", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    ranked = ranked.where(F.col("_position") <= kept)
    if repeat_flag is not None:
        ranked = ranked.withColumn(repeat_flag, F.count("*").over(W.partitionBy(*keys)) > 1)
        ranked = ranked.where(F.col("_position") == 1)
    return ranked.drop("_position")


def losers(df: DataFrame, keys: Sequence[str], row_id: str, best: Column, kept: str) -> DataFrame:
    """Rows that deduplication drops, with the id of the row kept in their place.

    ``best`` aggregates a group to a struct that holds ``row_id`` of the kept row. Keys are counted by
    hash first; only rows whose key repeats are then reduced and joined, on plain equality. Rows with
    a null key are the same event as others with the same nulls, and are looked at apart.
    """
    any_null = F.expr(" or ".join(f"{key} is null" for key in keys))
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > 1).select(*keys)
    plain = df.join(repeated, list(keys), "left_semi")
    winners = plain.groupBy(*keys).agg(best.alias("_best")).select(*keys, F.col(f"_best.{row_id}").alias(kept))
    dropped = plain.join(winners, list(keys)).select(*df.columns, kept)

    shadow = {key: f"_key_{i}" for i, key in enumerate(keys)}
    unknown = df.where(any_null)
    unknown_winners = unknown.groupBy(*keys).agg(best.alias("_best")).select(
        *[F.col(key).alias(name) for key, name in shadow.items()], F.col(f"_best.{row_id}").alias(kept)
    )
    same_group = [F.col(key).eqNullSafe(F.col(name)) for key, name in shadow.items()]
    dropped_unknown = unknown.join(unknown_winners, same_group).select(*df.columns, kept)
    return dropped.unionByName(dropped_unknown).where(F.col(row_id) != F.col(kept))


def number_in_group(df: DataFrame, key: str, first: str, rest: Sequence[str], name: str) -> DataFrame:
    """1-based position of each row in its group, ascending by the date ``first`` and then ``rest``.

    Rows are counted per group and date, and the counts of earlier dates are added to the position
    within the date. So a window never holds more than one date of a group, and the window over a
    group's dates at most one row per calendar day. Rows without a date come first.
    """
    dated = df.withColumn("_day", F.coalesce(first, F.lit("0001-01-01").cast("date")))
    earlier = W.partitionBy(key).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        dated.groupBy(key, "_day")
        .agg(F.count("*").alias("_rows"))
        .select(key, "_day", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(W.partitionBy(key, "_day").orderBy(*rest))
    return (
        dated.withColumn("_within", within)
        .join(offsets, [key, "_day"])
        .withColumn(name, F.col("_before") + F.col("_within"))
        .select(*df.columns, name)
    )
