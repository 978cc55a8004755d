"""Irregular pound quotes projected from the supplier table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.sources.star import StarTables


def project_fx_quotes(spark: SparkSession, star_dir: str) -> DataFrame:
    return StarTables(spark, star_dir).supplier.select(
        F.lit("GBP").alias("currency"),
        F.expr("date_add(date'2024-01-04', cast(s_suppkey * 53 % 360 as int))").alias("quoted_on"),
        F.col("s_suppkey").alias("quote_id"),
        F.expr(
            "timestamp_ntz'2024-01-04 00:00:00' + make_dt_interval(cast(s_suppkey * 53 % 360 as int), 0, 0, s_suppkey * 7919 % 86400)"
        ).alias("quoted_at"),
        F.expr("cast((12000 + s_suppkey * 37 % 1500) * 0.0001 as decimal(10,4))").alias("usd_rate"),
    )
