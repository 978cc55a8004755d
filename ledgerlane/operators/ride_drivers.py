"""Driver metrics and the driver mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import (
    average_or_zero,
    count_where,
    ratio_or_zero,
    ride_usd_rate,
    sum_usd,
    zero_if_null,
)

_TRIP_COUNTS = [
    "total_trips_assigned",
    "completed_trips",
    "cancelled_trips",
    "fraud_flagged_trips",
    "revenue_eligible_trips",
]
_TRIP_MONEY = ["gross_earnings_usd", "net_captured_usd"]
_LEDGER = [
    "total_incentive_paid",
    "total_incentive_paid_usd",
    "total_incentive_lines",
    "incentivized_trips",
    "campaigns_participated",
]


def _trip_metrics(trips: DataFrame) -> DataFrame:
    # First collapse to driver x city x product: the distinct counts then run over a few rows
    # per driver instead of expanding every trip once per distinct column.
    cells = (
        trips.where("driver_id is not null")
        .groupBy("driver_id", "city", "product")
        .agg(
            F.count("*").alias("total_trips_assigned"),
            count_where("is_completed").alias("completed_trips"),
            count_where("trip_status = 'cancelled'").alias("cancelled_trips"),
            count_where("is_fraud_flagged").alias("fraud_flagged_trips"),
            count_where("is_revenue_eligible").alias("revenue_eligible_trips"),
            sum_usd("gross_fare_usd", "is_completed").alias("gross_earnings_usd"),
            sum_usd("captured_amount_usd", "is_revenue_eligible").alias("net_captured_usd"),
            F.min("requested_at").alias("first_trip_at"),
            F.max("requested_at").alias("last_trip_at"),
        )
    )
    return cells.groupBy("driver_id").agg(
        *[F.expr(f"sum({name}) as {name}") for name in _TRIP_COUNTS + _TRIP_MONEY],
        F.min("first_trip_at").alias("first_trip_at"),
        F.max("last_trip_at").alias("last_trip_at"),
        F.count_distinct("city").alias("cities_operated"),
        F.count_distinct("product").alias("products_served"),
    )


def _ledger_totals(incentives: DataFrame) -> DataFrame:
    # Campaigns are few, so amounts collapse to driver x campaign; trips are counted from distinct
    # pairs of their own. Counting both at once would expand every line.
    per_campaign = incentives.groupBy("driver_id", "campaign").agg(
        F.sum("bonus_amount").alias("paid"),
        F.expr(f"sum(bonus_amount * {ride_usd_rate()})").alias("paid_usd"),
        F.count("*").alias("lines"),
    )
    totals = per_campaign.groupBy("driver_id").agg(
        F.sum("paid").alias("total_incentive_paid"),
        F.sum("paid_usd").alias("total_incentive_paid_usd"),
        F.sum("lines").alias("total_incentive_lines"),
        F.count("campaign").alias("campaigns_participated"),
    )
    trips = incentives.select("driver_id", "trip_id").distinct().groupBy("driver_id").agg(F.count("trip_id").alias("incentivized_trips"))
    return totals.join(trips, "driver_id")


def driver_metrics(drivers: DataFrame, trips: DataFrame, incentives: DataFrame) -> DataFrame:
    """One row per driver. Incentive totals stay in ledger units so they tie to the payouts."""
    return (
        drivers.join(_trip_metrics(trips), "driver_id", "left")
        .join(_ledger_totals(incentives), "driver_id", "left")
        .select(
            *drivers.columns,
            *[zero_if_null(name) for name in _TRIP_COUNTS + _TRIP_MONEY + _LEDGER],
            "first_trip_at",
            "last_trip_at",
            "cities_operated",
            "products_served",
        )
        .withColumns(
            {
                "completion_rate": ratio_or_zero("completed_trips", "total_trips_assigned", 4),
                "fraud_rate": ratio_or_zero("fraud_flagged_trips", "completed_trips", 4),
            }
        )
    )


def driver_mart(metrics: DataFrame, incentives: DataFrame, trips: DataFrame) -> DataFrame:
    flagged = trips.where("is_fraud_flagged").select("trip_id")
    leakage = (
        incentives.join(flagged, "trip_id", "left_semi")
        .groupBy("driver_id")
        .agg(F.sum("bonus_amount").alias("incentive_on_fraud_trips"))
    )
    return (
        metrics.join(leakage, "driver_id", "left")
        .select(*metrics.columns, zero_if_null("incentive_on_fraud_trips"))
        .withColumns(
            {
                "avg_fare_per_trip_usd": average_or_zero("gross_earnings_usd", "completed_trips", 2),
                "avg_incentive_per_trip": average_or_zero("total_incentive_paid", "completed_trips", 2),
            }
        )
    )


def ledger_comparison(metrics: DataFrame, raw_incentives: DataFrame) -> DataFrame:
    """Driver totals next to the raw payouts ledger."""
    ledger = raw_incentives.groupBy("driver_id").agg(F.sum("bonus_amount").alias("raw_total"))
    return (
        metrics.selectExpr("driver_id", "total_incentive_paid as mart_total")
        .join(ledger, "driver_id")
        .selectExpr(
            "driver_id",
            "mart_total",
            "raw_total",
            "mart_total - raw_total as diff",
            "abs(mart_total - raw_total) <= 0.01 as reconciles",
        )
    )
