"""Hand-made raw tables in which every rule passes, and helpers to break them."""

from types import SimpleNamespace

from pyspark.sql import DataFrame

from ledgerlane.plans.ride import RideModels
from ledgerlane.plans.workforce import WorkforceModels
from ledgerlane.sources.ride_projection import ProjectedRideTables
from ledgerlane.sources.tables import RIDE_SCHEMAS, WORKFORCE_SCHEMAS, conform
from ledgerlane.sources.workforce_projection import ProjectedWorkforceTables


def employees(spark, rows) -> DataFrame:
    """Rows of (employee, person, hired, ended, status, prior); everyone is in department 10."""
    full = [
        (e, p, f"Employee {p}", 10, "IC1", "full_time", "Berlin", hired, ended, status, prior)
        for e, p, hired, ended, status, prior in rows
    ]
    names = [part.split()[0] for part in WORKFORCE_SCHEMAS["employees"].split(",")]
    kinds = ["bigint", "bigint", "string", "bigint", *["string"] * 6, "bigint"]
    text = spark.createDataFrame(full, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return conform(text, WORKFORCE_SCHEMAS["employees"])


def workforce(spark, data, **tables) -> WorkforceModels:
    """Models over the projected tables, with some replaced."""
    raw = ProjectedWorkforceTables(spark, data)
    return WorkforceModels(
        SimpleNamespace(**{name: tables[name] if name in tables else getattr(raw, name) for name in WORKFORCE_SCHEMAS})
    )


def ride(spark, data, **tables) -> RideModels:
    raw = ProjectedRideTables(spark, data)
    return RideModels(
        SimpleNamespace(**{name: tables[name] if name in tables else getattr(raw, name) for name in RIDE_SCHEMAS})
    )
