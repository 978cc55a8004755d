"""Ride-hailing models from raw tables to marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property

from pyspark.sql import DataFrame

from ledgerlane.functions.durable import durable
from ledgerlane.operators import ride_drivers, ride_finance, ride_riders, ride_staging
from ledgerlane.operators.ride_distance import COORDINATES
from ledgerlane.operators.ride_trips import enrich_trips
from ledgerlane.sources.tables import RideTables


class RideModels:
    """Lazy models over one set of raw tables.

    ``keep`` is applied to the trip fact that most marts read. By default it stays a view; pass
    ``durable`` when several marts are built from the same object.
    """

    def __init__(self, raw: RideTables, keep: Callable[[DataFrame, str], DataFrame] | None = None):
        self.raw = raw
        self._keep = keep or (lambda df, label: df)

    @cached_property
    def stg_riders(self) -> DataFrame:
        return ride_staging.riders(self.raw.riders)

    @cached_property
    def stg_drivers(self) -> DataFrame:
        return ride_staging.drivers(self.raw.drivers)

    @cached_property
    def stg_trips(self) -> DataFrame:
        return ride_staging.trips(self.raw.trips)

    @cached_property
    def stg_payments(self) -> DataFrame:
        return ride_staging.payments(self.raw.payments)

    @cached_property
    def stg_driver_incentives(self) -> DataFrame:
        return ride_staging.driver_incentives(self.raw.driver_incentives)

    @cached_property
    def int_trips_enriched(self) -> DataFrame:
        per_trip = ride_staging.incentives_per_trip(self.raw.driver_incentives)
        return self._keep(enrich_trips(self.stg_trips, self.stg_payments, per_trip), "trips-enriched")

    @cached_property
    def located_trips(self) -> DataFrame:
        """The trip fact with the trips' coordinates."""
        per_trip = ride_staging.incentives_per_trip(self.raw.driver_incentives)
        return enrich_trips(self.stg_trips, self.stg_payments, per_trip, COORDINATES)

    @cached_property
    def int_driver_metrics(self) -> DataFrame:
        return ride_drivers.driver_metrics(
            self.stg_drivers, self.int_trips_enriched, self.raw.driver_incentives
        )

    @cached_property
    def int_rider_activity(self) -> DataFrame:
        return ride_riders.rider_activity(self.stg_riders, self.int_trips_enriched, self.stg_trips)

    @cached_property
    def mart_drivers(self) -> DataFrame:
        return ride_drivers.driver_mart(self.int_driver_metrics, self.raw.driver_incentives, self.stg_trips)

    @cached_property
    def mart_riders(self) -> DataFrame:
        return ride_riders.rider_mart(self.int_rider_activity)

    @cached_property
    def mart_marketplace_kpis(self) -> DataFrame:
        return ride_finance.marketplace_kpis(self.int_trips_enriched, self.stg_trips)

    @cached_property
    def mart_reconciliation(self) -> DataFrame:
        return ride_finance.revenue_bridge(self.int_trips_enriched)

    def settle(self, names: Iterable[str]) -> None:
        """Write these models and use the written copies from now on."""
        for name in names:
            self.__dict__[name] = durable(getattr(self, name), name)

    def marts(self) -> dict[str, DataFrame]:
        return {
            name: getattr(self, name)
            for name in ("mart_drivers", "mart_riders", "mart_marketplace_kpis", "mart_reconciliation")
        }
