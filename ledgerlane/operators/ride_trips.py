"""Trip-grain fact: fare, settled payment, incentives and dollars on one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerlane.functions.columns import ride_usd_rate

_FROM_TRIP = [
    "trip_id",
    "rider_id",
    "driver_id",
    "city",
    "product",
    "trip_status",
    "cancel_reason",
    "trip_classification",
    "is_completed",
    "is_revenue_eligible",
    "has_cancellation_fee",
    "is_fraud_flagged",
    "surge_multiplier",
    "currency",
    "gross_fare",
    "requested_at",
    "accepted_at",
    "started_at",
    "ended_at",
]


def enrich_trips(
    trips: DataFrame, payments: DataFrame, incentives_per_trip: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """All three inputs are keyed by trip, so each is shuffled once on trip_id and zipped.

    ``extra`` names further columns of the trips to carry along.
    """
    settled = payments.selectExpr(
        "trip_id",
        "payment_id",
        "amount",
        "processor_fee as fee",
        "has_duplicate_captures as captured_twice",
        "payment_method",
        "captured_at",
    )
    joined = trips.join(settled, "trip_id", "left").join(incentives_per_trip, "trip_id", "left")
    local = joined.selectExpr(
        *_FROM_TRIP,
        *extra,
        "coalesce(amount, 0) as captured_amount",
        "coalesce(fee, 0) as processor_fee",
        "coalesce(total_incentive_amount, 0) as incentive_amount",
        f"{ride_usd_rate()} as exchange_rate",
        "payment_id is not null as has_captured_payment",
        "coalesce(captured_twice, false) as has_duplicate_captures",
        "coalesce(is_multi_campaign_trip, false) as is_multi_campaign_trip",
        "coalesce(incentive_line_count, 0) as incentive_line_count",
        "payment_method",
        "captured_at",
    )
    return local.selectExpr(
        "*",
        """if(is_revenue_eligible or has_cancellation_fee, captured_amount - processor_fee, 0)
           as net_revenue_local""",
        "gross_fare * exchange_rate as gross_fare_usd",
        "captured_amount * exchange_rate as captured_amount_usd",
        "processor_fee * exchange_rate as processor_fee_usd",
        "incentive_amount * exchange_rate as incentive_amount_usd",
    )
