"""Folders of whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system knows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def children(spark: SparkSession, path: str) -> dict[str, float]:
    """Names in a folder and the seconds since the epoch of their last change; none where there is no folder."""
    files, folder = filesystem(spark, path)
    if not files.exists(folder):
        return {}
    return {status.getPath().getName(): status.getModificationTime() / 1000 for status in files.listStatus(folder)}


def delete(spark: SparkSession, path: str) -> None:
    files, target = filesystem(spark, path)
    files.delete(target, True)
