"""Great-circle trip distance and what it earns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import ratio

EARTH_RADIUS_KM = 6371.0
BAND_KM = 2
COORDINATES = ["pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"]


def haversine_km(lat_1: Column, lon_1: Column, lat_2: Column, lon_2: Column) -> Column:
    angles = [F.radians(c.cast("double")) for c in (lat_1, lon_1, lat_2, lon_2)]
    half_lat = (angles[2] - angles[0]) / 2
    half_lon = (angles[3] - angles[1]) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(angles[0]) * F.cos(angles[2]) * F.pow(
        F.sin(half_lon), F.lit(2.0)
    )
    return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_KM)


def trip_distances(trips: DataFrame) -> DataFrame:
    """Completed trips with distance, from a trip fact that carries COORDINATES."""
    km = haversine_km(*[F.col(c) for c in COORDINATES])
    return (
        trips.where("is_completed")
        .withColumn("distance_km", F.round(km, 6).cast("decimal(18,6)"))
        .selectExpr(
            "trip_id",
            "city",
            "product",
            "surge_multiplier",
            "distance_km",
            "if(is_revenue_eligible, captured_amount_usd - processor_fee_usd, 0) as net_revenue_usd",
        )
        .withColumn("revenue_per_km", ratio("net_revenue_usd", "distance_km", 4))
    )


def surge_by_distance(distances: DataFrame) -> DataFrame:
    """Revenue per kilometre and average surge for each city and distance band."""
    band = (F.floor(F.col("distance_km") / BAND_KM) * BAND_KM).cast("bigint")
    return (
        distances.groupBy("city", band.alias("band_from_km"))
        .agg(
            F.count("*").alias("trips"),
            F.sum("distance_km").alias("total_km"),
            F.sum("net_revenue_usd").alias("net_revenue_usd"),
            F.sum("surge_multiplier").alias("surge_sum"),
        )
        .withColumn("revenue_per_km", ratio("net_revenue_usd", "total_km", 4))
        .withColumn("avg_surge", ratio("surge_sum", "trips", 4))
        .drop("surge_sum")
    )
