"""Source freshness against an explicit as-of time."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def freshness(
    sources: dict[str, tuple[DataFrame, str]], as_of: datetime, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Latest load time, age and status of each source; a source without rows is an error."""
    newest = [
        table.agg(F.max(column).cast("timestamp_ntz").alias("last_loaded_at")).withColumn("source", F.lit(name))
        for name, (table, column) in sources.items()
    ]
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    age = (now - F.col("last_loaded_at")).cast("interval second").cast("bigint") / 3600
    status = (
        F.when(F.col("age_hours") <= warn_hours, "pass")
        .when(F.col("age_hours") <= error_hours, "warn")
        .otherwise("error")
    )
    return (
        reduce(DataFrame.unionByName, newest)
        .withColumn("age_hours", F.round(age, 4))
        .withColumn("status", status)
    )
