"""Data-quality rules of the ride-hailing models."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.operators.checks import (
    Check,
    ModelTests,
    is_staged,
    relationships,
    run_model_tests,
    with_status,
)
from ledgerlane.operators.quarantine import Partner, RowRules
from ledgerlane.operators.ride_drivers import ledger_comparison
from ledgerlane.plans.ride import RideModels

DEFAULT_NOW = datetime(2026, 1, 1)

TRIP_CLASSES = ["completed", "completed_fraud", "cancelled_no_match", "cancelled_billed"]
LIFECYCLE_STAGES = ["active", "lapsing", "churned", "never_rode"]

MODEL_TESTS = [
    ModelTests("raw_riders", ["rider_id"], ["rider_id"]),
    ModelTests("raw_drivers", ["driver_id"]),
    ModelTests("raw_trips", ["trip_id"], ["trip_id"]),
    ModelTests("raw_payments", ["payment_id"], ["payment_id"]),
    ModelTests("raw_driver_incentives", ["incentive_id"], ["incentive_id"]),
    ModelTests("stg_riders", ["rider_id"], ["rider_id"]),
    ModelTests("stg_drivers", ["driver_id"], ["driver_id"]),
    ModelTests("stg_trips", ["trip_id"], ["trip_id"], {"trip_classification": TRIP_CLASSES}),
    ModelTests("stg_payments", ["trip_id", "payment_id"], ["trip_id", "payment_id"]),
    ModelTests("stg_driver_incentives", ["incentive_id"], ["incentive_id"]),
    ModelTests("int_trips_enriched", ["trip_id", "trip_classification", "gross_fare_usd"], ["trip_id"]),
    ModelTests("int_driver_metrics", ["driver_id"], ["driver_id"], accepted_range={"completion_rate": (0, 1)}),
    ModelTests("int_rider_activity", ["rider_id"], ["rider_id"]),
    ModelTests("mart_drivers", ["driver_id"], ["driver_id"]),
    ModelTests("mart_riders", ["rider_id"], ["rider_id"], {"lifecycle_stage": LIFECYCLE_STAGES}),
    ModelTests("mart_marketplace_kpis", ["report_month"], ["report_month"]),
]


def _model(models: RideModels, name: str) -> DataFrame:
    return getattr(models.raw, name.removeprefix("raw_")) if name.startswith("raw_") else getattr(models, name)


def schema_test_report(models: RideModels, staged: bool | None = None) -> DataFrame:
    """Column tests of all models, or only of raw and staged ones, or only of the others."""
    chosen = [tests for tests in MODEL_TESTS if staged is None or staged == is_staged(tests.model)]
    outcomes = [run_model_tests(_model(models, tests.model), tests) for tests in chosen]
    return with_status(reduce(DataFrame.unionByName, outcomes))


def orphan_trips(models: RideModels, now: datetime) -> Check:
    missing = relationships(models.stg_trips, "rider_id", models.stg_riders, "rider_id")
    return Check("orphan_trips", "error", missing, "rows_affected")


def orphan_payments(models: RideModels, now: datetime) -> Check:
    missing = relationships(models.stg_payments, "trip_id", models.stg_trips, "trip_id")
    return Check("orphan_payments", "error", missing, "rows_affected")


def _in_future(now: datetime) -> Column:
    return F.col("requested_at") > F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def _over_fare() -> Column:
    return F.col("is_completed") & (F.col("captured_amount") > F.col("gross_fare") * F.lit(1.1).cast("decimal(2,1)"))


def _fraud_earns() -> Column:
    return F.col("is_fraud_flagged") & (F.col("net_revenue_local") > 0)


def negative_fares(models: RideModels, now: datetime) -> Check:
    return Check("negative_fares", "error", models.stg_trips.where(F.col("gross_fare") < 0))


def future_trips(models: RideModels, now: datetime) -> Check:
    return Check("future_trips", "warn", models.stg_trips.where(_in_future(now)))


def captured_lte_fare(models: RideModels, now: datetime) -> Check:
    return Check("captured_lte_fare", "warn", models.int_trips_enriched.where(_over_fare()))


def incentive_recon(models: RideModels, now: datetime) -> Check:
    compared = ledger_comparison(models.int_driver_metrics, models.raw.driver_incentives)
    return Check("incentive_recon", "error", compared.where(~F.col("reconciles")))


def no_fraud_revenue(models: RideModels, now: datetime) -> Check:
    return Check("no_fraud_revenue", "error", models.int_trips_enriched.where(_fraud_earns()))


def gap_bounds(models: RideModels, now: datetime) -> Check:
    outside = ~F.col("gap_rate").between(0.05, 0.20)
    return Check("gap_bounds", "warn", models.mart_reconciliation.where(outside))


def kpi_months(models: RideModels, now: datetime) -> Check:
    months = models.mart_marketplace_kpis.agg(F.count_distinct("report_month").alias("months"))
    return Check("kpi_months", "warn", months.where(F.col("months") < 12))


def rider_monotonic(models: RideModels, now: datetime) -> Check:
    counts = models.mart_riders.agg(
        F.count_if("is_active_30d").alias("active_30d"), F.count_if("is_active_90d").alias("active_90d")
    )
    return Check("rider_monotonic", "error", counts.where(F.col("active_30d") > F.col("active_90d")))


# Rules on models in build order; each takes the models and the time that counts as now.
RULES = {
    rule.__name__: rule
    for rule in (
        orphan_trips,
        orphan_payments,
        negative_fares,
        future_trips,
        captured_lte_fare,
        incentive_recon,
        no_fraud_revenue,
        gap_bounds,
        kpi_months,
        rider_monotonic,
    )
}

#: Rules that need a staged model only; they are looked at before any mart is built.
STAGING_RULES = ("orphan_trips", "orphan_payments", "negative_fares", "future_trips")


def row_rules(models: RideModels, now: datetime) -> list[tuple[DataFrame, RowRules]]:
    """Every model with rules that a single row can break: the column tests, and the rules above of that kind.

    Trips accepted before they were requested are set aside too; no check counts them.
    """
    own = {
        "stg_trips": (
            {
                "negative_fares": F.col("gross_fare") < 0,
                "future_trips": _in_future(now),
                "clock_skew": F.col("accepted_at") < F.col("requested_at"),
            },
            {"orphan_trips": Partner("rider_id", models.stg_riders, "rider_id")},
        ),
        "stg_payments": ({}, {"orphan_payments": Partner("trip_id", models.stg_trips, "trip_id")}),
        "int_trips_enriched": ({"captured_lte_fare": _over_fare(), "no_fraud_revenue": _fraud_earns()}, {}),
    }
    found = []
    for tests in MODEL_TESTS:
        conditions, partners = own.get(tests.model, ({}, {}))
        key = tests.unique[0] if tests.unique else tests.not_null[0]
        found.append((_model(models, tests.model), RowRules(tests.model, key, tests.row_conditions() | conditions, partners)))
    return found
