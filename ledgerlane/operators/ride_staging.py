"""Cleaned ride-hailing feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.groups import first_per_group


def riders(raw: DataFrame) -> DataFrame:
    return raw.selectExpr("*", "referred_by is not null as is_referred")


def drivers(raw: DataFrame) -> DataFrame:
    """One row per driver: the latest onboarding, with the first and last onboarding times."""
    # The columns after onboarded_at only settle ties between identical times.
    latest = ["onboarded_at", "vehicle_class", "driver_status", "home_city", "rating"]
    newest = first_per_group(raw, ["driver_id"], [F.col(name).desc_nulls_last() for name in latest])
    counted = raw.groupBy("driver_id").agg(
        F.min("onboarded_at").alias("first_onboarded_at"), F.count("*").alias("onboardings")
    )
    driver = newest["driver_id"].eqNullSafe(counted["driver_id"])
    return newest.join(counted, driver).select(
        newest["driver_id"],
        "home_city",
        "driver_status",
        "vehicle_class",
        "rating",
        "first_onboarded_at",
        F.col("onboarded_at").alias("last_onboarded_at"),
        (F.col("onboardings") > 1).alias("is_reonboarded"),
    )


def trips(raw: DataFrame) -> DataFrame:
    """All trips with their class; an unknown fraud flag is neither fraud nor eligible."""
    return raw.selectExpr(
        "*",
        """case when trip_status = 'completed' then if(is_fraud_flagged, 'completed_fraud',
                                                      if(not is_fraud_flagged, 'completed', null))
                when trip_status = 'cancelled' then if(cancel_reason = 'no_driver_found', 'cancelled_no_match',
                                                      'cancelled_billed')
           end as trip_classification""",
        "coalesce(trip_status = 'completed', false) as is_completed",
        "coalesce(trip_status = 'completed' and not is_fraud_flagged, false) as is_revenue_eligible",
        """coalesce(trip_status = 'cancelled' and cancel_reason <> 'no_driver_found', false)
           as has_cancellation_fee""",
    )


def payments(raw: DataFrame) -> DataFrame:
    """The first successful capture of each trip."""
    captured = raw.where(F.col("payment_status") == "captured")
    earliest = [F.col("captured_at").asc_nulls_last(), F.col("payment_id").asc()]
    settled = first_per_group(captured, ["trip_id"], earliest, repeat_flag="has_duplicate_captures")
    return settled.withColumn("capture_rank", F.lit(1))


def failed_attempts(raw: DataFrame) -> DataFrame:
    """Capture attempts that did not go through."""
    return raw.where(F.col("payment_status") == "failed")


def incentives_per_trip(raw: DataFrame) -> DataFrame:
    return raw.groupBy("trip_id").agg(
        F.sum("bonus_amount").alias("total_incentive_amount"),
        F.count("*").alias("incentive_line_count"),
        (F.count("*") > 1).alias("is_multi_campaign_trip"),
    )


def driver_incentives(raw: DataFrame) -> DataFrame:
    """Every incentive line; lines are real payouts and are never removed.

    The line count joins back from a pre-aggregate on the plain key, so a trip with very many lines
    can be split across tasks, and a table bucketed on trip_id is not shuffled. Lines without a trip
    are counted together, by themselves.
    """
    overlap = incentives_per_trip(raw).select(
        "trip_id", F.col("incentive_line_count").alias("incentives_per_trip"), "is_multi_campaign_trip"
    )
    loose = raw.where("trip_id is null").agg(F.count("*")).scalar()
    own = F.when(F.col("trip_id").isNull(), loose).otherwise(F.col("incentives_per_trip"))
    counted = raw.join(overlap, "trip_id", "left").withColumns({"incentives_per_trip": own, "is_multi_campaign_trip": own > 1})
    return counted.select(*raw.columns, "incentives_per_trip", "is_multi_campaign_trip")
