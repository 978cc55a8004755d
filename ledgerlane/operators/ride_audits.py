"""What the ride-hailing models set aside: failed attempts, duplicates and clock skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import ratio, ride_usd_rate
from ledgerlane.functions.groups import losers
from ledgerlane.operators.ride_staging import failed_attempts


def failed_attempts_with_outcome(raw_payments: DataFrame) -> DataFrame:
    """Failed capture attempts and whether the trip was captured in the end."""
    captured = (
        raw_payments.where(F.col("payment_status") == "captured")
        .groupBy("trip_id")
        .agg(F.min("captured_at").alias("recovered_at"))
    )
    return (
        failed_attempts(raw_payments)
        .join(captured, "trip_id", "left")
        .select(
            "payment_id",
            "trip_id",
            "payment_method",
            "currency",
            "amount",
            "attempted_at",
            "recovered_at",
            F.col("recovered_at").isNotNull().alias("was_recovered"),
        )
    )


def retry_rates(raw_payments: DataFrame) -> DataFrame:
    """Attempt outcomes by the month of each trip's first attempt."""
    failed = F.col("payment_status") == "failed"
    per_trip = raw_payments.groupBy("trip_id").agg(
        F.expr("trunc(cast(min(attempted_at) as date), 'MM')").alias("attempt_month"),
        F.count("*").alias("attempts"),
        F.count_if(failed).alias("failures"),
        F.count_if(F.col("payment_status") == "captured").alias("captures"),
    )
    hit = F.col("failures") > 0
    return (
        per_trip.groupBy("attempt_month")
        .agg(
            F.count("*").alias("trips_attempted"),
            F.sum("attempts").alias("attempts"),
            F.sum("failures").alias("failed_attempts"),
            F.count_if(hit & (F.col("attempts") > 1)).alias("trips_retried"),
            F.count_if(hit & (F.col("captures") > 0)).alias("trips_recovered"),
        )
        .withColumn("failure_rate", ratio("failed_attempts", "attempts", 4))
        .withColumn("retry_rate", ratio("trips_retried", "trips_attempted", 4))
    )


def _superseded_onboardings(raw_drivers: DataFrame) -> DataFrame:
    # Rows of one driver and time are counted: of those at the kept time one is kept, the rest and all
    # rows at other times, or without one, are listed.
    times = raw_drivers.groupBy("driver_id", "onboarded_at").agg(F.count("*").alias("rows_at"))
    newest = times.groupBy("driver_id").agg(F.max("onboarded_at").alias("kept_at"), F.sum("rows_at").alias("onboardings"))
    kept = F.col("onboarded_at").eqNullSafe(F.col("kept_at")).cast("bigint")
    return (
        times.join(newest.where(F.col("onboardings") > 1), "driver_id")
        .withColumn("left_out", F.col("rows_at") - kept)
        .where(F.col("left_out") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("left_out"))))
        .select(
            F.lit("driver_onboarding").alias("entity"),
            F.col("driver_id").alias("entity_id"),
            F.lit(None).cast("bigint").alias("discarded_id"),
            F.lit(None).cast("bigint").alias("kept_id"),
            F.col("onboarded_at").alias("recorded_at"),
            F.lit(0).cast("decimal(16,4)").alias("excess_usd"),
        )
    )


def extra_captures(raw_payments: DataFrame) -> DataFrame:
    captured = raw_payments.where(F.col("payment_status") == "captured")
    earliest = F.min(F.struct(F.col("captured_at").isNull(), "captured_at", "payment_id"))
    return losers(captured, ["trip_id"], "payment_id", earliest, "kept_id").select(
        F.lit("duplicate_capture").alias("entity"),
        F.col("trip_id").alias("entity_id"),
        F.col("payment_id").alias("discarded_id"),
        "kept_id",
        F.col("captured_at").alias("recorded_at"),
        F.expr(f"amount * {ride_usd_rate()}").alias("excess_usd"),
    )


def dedup_audit(raw_drivers: DataFrame, raw_payments: DataFrame) -> DataFrame:
    """Every row that deduplication left out, with the money it would have counted twice."""
    return _superseded_onboardings(raw_drivers).unionByName(extra_captures(raw_payments))


def clock_skew(trips: DataFrame) -> DataFrame:
    """Trips accepted before they were requested."""
    early_by = F.col("requested_at") - F.col("accepted_at")
    return trips.where(F.col("accepted_at") < F.col("requested_at")).select(
        "trip_id",
        "city",
        "trip_status",
        "requested_at",
        "accepted_at",
        early_by.cast("interval second").cast("bigint").alias("skew_seconds"),
    )
