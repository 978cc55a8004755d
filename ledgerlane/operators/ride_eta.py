"""How long riders wait and ride, and how fast, by city, hour and distance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.quantiles import BITS, merge, quantiles, sketch
from ledgerlane.operators.ride_distance import BAND_KM, COORDINATES, haversine_km

FINEST = ["city", "request_hour", "band_from_km", "measure"]
#: Levels from fine to coarse; each is added up from the one before.
LEVELS = {
    "city_hour_band": FINEST,
    "city_hour": ["city", "request_hour", "measure"],
    "city": ["city", "measure"],
    "all": ["measure"],
}
PERCENTS = {"median": 50, "p90": 90}


def eta_sketch(trips: DataFrame, bits: int = BITS) -> DataFrame:
    """Counts per city, hour, distance band, measure and cell, from one pass over a trip fact that carries COORDINATES.

    Measures are whole seconds from request to start and from start to end, and whole metres an hour. Trips that are
    not completed do not count; a measure that a trip lacks, or of a time that runs backwards, counts for the others only.
    The sketch has no more rows than groups times cells; store it and add later ones with ``merge``.
    """
    km = F.round(haversine_km(*[F.col(c) for c in COORDINATES]), 6).cast("decimal(18,6)")
    seconds = "cast(floor(cast({1} - {0} as decimal(24,6))) as bigint)"
    timed = (
        trips.where("is_completed")
        .withColumn("km", km)
        .selectExpr(
            "city",
            "hour(requested_at) as request_hour",
            f"cast(floor(km / {BAND_KM}) * {BAND_KM} as bigint) as band_from_km",
            "cast(km * 1000000 as bigint) as millimetres",
            f"{seconds.format('requested_at', 'started_at')} as waited",
            f"{seconds.format('started_at', 'ended_at')} as rode",
        )
    )
    measures = """stack(3, 'pickup_seconds', if(waited >= 0, waited, null), 'ride_seconds', if(rode >= 0, rode, null),
                        'metres_an_hour', if(rode > 0, millimetres * 3600 div (rode * 1000), null)) as (measure, value)"""
    return sketch(timed.selectExpr("city", "request_hour", "band_from_km", measures), FINEST, "value", bits)


def eta_bands(finest: DataFrame) -> DataFrame:
    """Median and 90th percentile of each measure at every level; columns that a level has added up are null."""
    found, level = [], finest
    for name, keys in LEVELS.items():
        level = level if keys == FINEST else merge(level, keys)
        absent = [F.lit(None).cast(finest.schema[c].dataType).alias(c) for c in FINEST if c not in keys]
        rows = quantiles(level, keys, PERCENTS).withColumnRenamed("n", "trips")
        found.append(rows.select(F.lit(name).alias("level"), *keys, *absent, "trips", *PERCENTS))
    return reduce(DataFrame.unionByName, found)
