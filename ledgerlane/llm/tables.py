"""Reading the tables of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def text_key(text: Column) -> Column:
    """A hash that tells apart rows of one id."""
    return F.xxhash64(text)


def without_rows(docs: DataFrame, gone: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id and text hash are not among the columns gone_id and gone_key of ``gone``."""
    found = (text_key(docs[text_column]) == gone["gone_key"]) & docs[id_column].eqNullSafe(gone["gone_id"])
    return docs.join(gone, found, "left_anti")
