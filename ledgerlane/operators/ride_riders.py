"""Rider activity under four definitions of active, and the rider mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import (
    average_or_zero,
    count_where,
    ratio_or_zero,
    sum_usd,
)

_MEASURES = [
    "total_trips_requested",
    "completed_trips",
    "completed_nonfraud_trips",
    "cancelled_trips",
    "fraud_trips",
    "total_gross_fare_usd",
    "total_captured_usd",
]
_FLAGS = ["is_active_30d", "is_active_90d", "is_active_any_trip_30d"]


def rider_activity(riders: DataFrame, trips: DataFrame, requests: DataFrame) -> DataFrame:
    """One row per rider; trailing windows end at the latest request in ``requests``."""
    latest = requests.agg(F.expr("cast(max(requested_at) as date)")).scalar()
    asked_on = F.expr("cast(requested_at as date)")
    eligible = F.col("is_revenue_eligible")
    last_30 = asked_on >= F.date_sub(latest, 30)
    last_90 = asked_on >= F.date_sub(latest, 90)
    per_rider = trips.groupBy("rider_id").agg(
        F.count("*").alias("total_trips_requested"),
        count_where("is_completed").alias("completed_trips"),
        count_where("is_revenue_eligible").alias("completed_nonfraud_trips"),
        count_where("trip_status = 'cancelled'").alias("cancelled_trips"),
        count_where("is_fraud_flagged").alias("fraud_trips"),
        sum_usd("gross_fare_usd").alias("total_gross_fare_usd"),
        sum_usd("captured_amount_usd", "is_revenue_eligible").alias("total_captured_usd"),
        F.min("requested_at").alias("first_trip_at"),
        F.max("requested_at").alias("last_trip_at"),
        F.bool_or(eligible & last_30).alias("is_active_30d"),
        F.bool_or(eligible & last_90).alias("is_active_90d"),
        F.bool_or(last_30).alias("is_active_any_trip_30d"),
    )
    return riders.join(per_rider, "rider_id", "left").selectExpr(
        "rider_id",
        "home_city",
        "account_status",
        "signup_at",
        "is_referred",
        *[f"coalesce({name}, 0) as {name}" for name in _MEASURES],
        "first_trip_at",
        "last_trip_at",
        "coalesce(account_status = 'active', false) as is_active_account",
        *[f"coalesce({name}, false) as {name}" for name in _FLAGS],
    )


def rider_mart(activity: DataFrame) -> DataFrame:
    return activity.withColumns(
        {
            "completion_rate": ratio_or_zero("completed_nonfraud_trips", "total_trips_requested", 4),
            "avg_fare_per_trip_usd": average_or_zero("total_gross_fare_usd", "completed_trips", 2),
            "lifecycle_stage": F.expr(
                """case when total_trips_requested = 0 then 'never_rode' when is_active_30d then 'active'
                        when is_active_90d then 'lapsing' else 'churned' end"""
            ),
        }
    )


def active_rider_counts(mart: DataFrame) -> DataFrame:
    return mart.agg(
        count_where("is_active_account").alias("active_by_crm"),
        count_where("is_active_30d").alias("active_30d_completed"),
        count_where("is_active_90d").alias("active_90d_completed"),
        count_where("is_active_any_trip_30d").alias("active_30d_any_trip"),
    )
