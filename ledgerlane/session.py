"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

# Settings that hold at any scale. Partition counts are left to adaptive execution, which
# coalesces small shuffles and splits skewed ones; forceOptimizeSkewedJoin lets it split a hot
# join key even where that costs a later shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, master: str | None = None, **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return share_code(builder.getOrCreate())


def share_code(spark: SparkSession) -> SparkSession:
    """Let Python workers that see this installation's folder import the library; ship it with
    ``--py-files`` where they do not."""
    root, path = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{path}".rstrip(":")
    return spark
