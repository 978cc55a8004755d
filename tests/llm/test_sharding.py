"""Shards against the SQL statement and their own promises."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from ledgerlane.llm.sharding import assign_shards, oracle_sql, write_shards


@pytest.mark.parametrize("limit", [1 << 26, 200_000, 20_000, 5_000, 50])
def test_shards_equal_those_of_the_statement(spark, data, limit):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert differences(assign_shards(docs, limit=limit), connect(data), oracle_sql(limit)) == []


def test_rows_of_one_key_are_told_apart(spark):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x" * 100).alias("text"))
    placed = assign_shards(docs, limit=1000).collect()
    assert len(placed) == 3000
    assert max(r.shard_bytes for r in placed) <= 1000 and all(r.fits for r in placed)
    assert min(r.depth for r in placed) >= 60


def test_native(spark, data):
    plan = assign_shards(spark.read.parquet(f"{data}/documents.parquet"), limit=5000)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_nulls_large_rows_empty_tables_and_clashing_columns(spark, tmp_path):
    docs = spark.createDataFrame(
        [(None, None, 1, 2), (None, "", 1, 2), (1, "x" * 5000, 1, 2), (2, "é", 1, 2), (2, "é", 1, 2)],
        "doc_id long, text string, shard int, bits int",
    )
    rows = assign_shards(docs, limit=100).collect()
    assert len(rows) == 5
    assert [r.fits for r in rows if r.doc_id == 1] == [False] and all(r.fits for r in rows if r.doc_id != 1)
    assert assign_shards(docs.limit(0)).count() == 0
    write_shards(docs, f"{tmp_path}/shards", limit=100)
    assert spark.read.parquet(f"{tmp_path}/shards").count() == 5
