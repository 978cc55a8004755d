"""The star-schema tables the projections start from."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

# The columns the projections read. Declared, so no job runs to infer them.
_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE",
}


class StarTables:
    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(_SCHEMAS[name]).parquet(f"{self._folder}/{name}.parquet")

    @cached_property
    def customer(self) -> DataFrame:
        return self._read("customer")

    @cached_property
    def supplier(self) -> DataFrame:
        return self._read("supplier")

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders")
