"""Which campaigns pay for the same trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import ride_usd_rate


def campaign_overlap(incentives: DataFrame, trips: DataFrame) -> DataFrame:
    """One row per set of campaigns that occurs within a trip's set: trips paid by exactly this set, trips paid by
    all of it and perhaps others, and for the former their lines, spend, and the excess over the best line alone.

    A trip's campaigns are the bits of one number, so lines are reduced to trips by a hash aggregate, and trips to
    sets; only the sets are then spread over their subsets. There may be up to 62 campaigns. Lines of unknown trips
    are left out, and so are lines without a campaign. Lines, trips with several lines, and spend add up to the
    multi-campaign report over all months.
    """
    known = incentives.where("campaign is not null").join(trips.select("trip_id"), "trip_id", "left_semi")
    names = incentives.agg(F.sort_array(F.collect_set("campaign"))).scalar()
    coded = known.select(
        "trip_id",
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.array_position(names, F.col("campaign")) - 1).cast("int")).alias("bit"),
        F.expr(f"bonus_amount * {ride_usd_rate()}").alias("usd"),
    )
    per_trip = coded.groupBy("trip_id").agg(
        F.bit_or("bit").alias("members"), F.count("*").alias("lines"), F.sum("usd").alias("usd"), F.max("usd").alias("best")
    )
    exactly = per_trip.groupBy("members").agg(
        F.count("*").alias("trips"),
        F.sum("lines").alias("lines"),
        F.count_if(F.col("lines") > 1).alias("trips_with_several_lines"),
        F.sum("usd").alias("spend_usd"),
        F.sum(F.col("usd") - F.col("best")).alias("excess_usd"),
    )
    # Every subset of a set of bits, by adding one bit after the other to all subsets so far.
    bits = F.filter(F.transform(F.sequence(F.lit(0), F.lit(61)), lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), k)),
                    lambda bit: F.col("members").bitwiseAND(bit) != 0)
    subsets = F.aggregate(
        bits, F.array(F.lit(0).cast("bigint")), lambda found, bit: F.concat(found, F.transform(found, lambda s: s.bitwiseOR(bit)))
    )
    own = [c for c in exactly.columns if c != "members"]
    spread = exactly.withColumn("subset", F.explode(subsets)).where("subset <> 0")
    is_whole = F.col("subset") == F.col("members")
    totals = spread.groupBy("subset").agg(
        *[F.sum(F.when(is_whole, F.col(c)).otherwise(0)).alias(c) for c in own], F.sum("trips").alias("trips_at_least")
    )
    listed = F.filter("names", lambda name: F.col("subset").bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.array_position("names", name) - 1).cast("int"))) != 0)
    return totals.withColumn("names", names).select(
        F.array_join(listed, "+").alias("campaigns"), F.bit_count("subset").cast("bigint").alias("n_campaigns"),
        "trips_at_least", F.col("trips").alias("trips_exactly"), *own[1:],
    )
