"""Cutting lineage with tables in the shared folder the cluster names."""

from __future__ import annotations

import atexit
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``."""
    folder = spark.conf.get(FOLDER_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {FOLDER_SETTING} to a folder that the driver and every executor can reach")
    return folder.rstrip("/")


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/ledgerlane/{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder of this application, deleted like its other tables."""
    _delete_at_exit(spark)
    return f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike a cached plan the result survives lost executors, keeps exact size statistics for join
    planning, and is read column by column. ``drop_durable`` deletes a table that nothing reads any
    more; what is left is deleted when the application's Python process ends.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._durable_path = path
    return table


def drop_durable(*tables: DataFrame) -> None:
    """Delete tables made by ``durable``. No plan that is still to run may read them."""
    for table in tables:
        _delete(table.sparkSession, table._durable_path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_watched: set[str] = set()


def _delete_at_exit(spark: SparkSession) -> None:
    folder = application_folder(spark)
    if folder in _watched:
        return
    _watched.add(folder)

    def clean() -> None:
        try:
            _delete(spark, folder)
        except (Py4JError, OSError):
            pass  # the JVM has ended; the folder is named after the application

    atexit.register(clean)
