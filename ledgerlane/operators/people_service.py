"""Service with a rule that it starts anew after a long time away."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import years
from ledgerlane.functions.ranges import merged

RESET_DAYS = 730


def tenure_bridged(spans: DataFrame, history: DataFrame, as_of: date, reset_days: int = RESET_DAYS) -> DataFrame:
    """Service per person when days are counted once and service starts anew after ``reset_days`` or more away.

    Stints that overlap are united first, so a day never counts twice; the united stretches are then
    chained as long as the time away between them stays below the limit, and only the last chain
    counts. ``clock_days`` run from the first start to the last end without a break, which no service exceeds. Each step from the published service to the bridged one is a column, and their sum is exact:
    ``tenure_total_service_days - overlapping_days - days_before_reset = bridged_service_days``. A stint that is
    still open runs to ``as_of``. A stint without a start date has no days; one that ends before it starts counts
    for nothing here, while its negative days stay in the published figure and so in the overlap.
    """
    person = ["person_id"]
    ranges = spans.select(
        "person_id", F.col("stint_start_date").alias("lo"), F.coalesce("stint_end_date", F.lit(as_of)).alias("hi")
    )
    served = merged(ranges, person).withColumn("days", F.date_diff("hi", "lo").cast("bigint"))
    chains = merged(served, person, reset_days - 1).withColumnsRenamed({"lo": "chain_start", "hi": "chain_end"})
    last = chains.groupBy("person_id").agg(
        F.max("chain_start").alias("service_since"), (F.count("*") - 1).alias("service_resets")
    )
    totals = (
        served.join(last, "person_id")
        .groupBy("person_id", "service_since", "service_resets")
        .agg(
            F.sum("days").alias("covered_days"),
            F.date_diff(F.max("hi"), F.min("lo")).cast("bigint").alias("clock_days"),
            F.sum(F.when(F.col("lo") >= F.col("service_since"), F.col("days")).otherwise(0)).alias("bridged_service_days"),
            (F.count("*") - 1).alias("times_away"),
        )
    )
    kept = ["person_id", "is_currently_active", "tenure_total_service_days", "tenure_continuous_days"]
    counts = ["covered_days", "clock_days", "bridged_service_days", "times_away", "service_resets"]
    return (
        history.select(*kept)
        .join(totals, "person_id", "left")
        .withColumns({name: F.coalesce(name, F.lit(0).cast("bigint")) for name in counts})
        .select(
            *kept,
            (F.coalesce("tenure_total_service_days", F.lit(0)) - F.col("covered_days")).alias("overlapping_days"),
            (F.col("covered_days") - F.col("bridged_service_days")).alias("days_before_reset"),
            "bridged_service_days",
            "clock_days",
            years("bridged_service_days").alias("bridged_service_years"),
            "service_since",
            "times_away",
            "service_resets",
        )
    )
