"""Exact top-k against brute force and SQL."""

import math

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from ledgerlane.llm import topk
from ledgerlane.llm.queries import ORACLE_SQL, QUERIES
from ledgerlane.llm.topk import exact_top_k


def brute_force(rows, k, every):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.setdefault(i, set()).add(tuple(math.floor(256 * x) for x in v))
    flat = [(i, v) for i, vs in kept.items() for v in vs]
    out = []
    for q, v in flat:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in flat if c != q)
            out += [(q, n, c, -s) for n, (s, c) in enumerate(scored[:k], start=1)]
    return sorted(out)


def found(spark, rows, k, every, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score string")
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_top_k(df, F.col("id") % every == 0, k, **options).collect())


@pytest.mark.parametrize("lists", [1, 2, 3, 5])
def test_random_vectors_with_ties_and_odd_rows(spark, lists, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(lists)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=7) * rng.choice([0.01, 1, -3])], 1, "s") for i in range(150)]
    rows += [(i, rows[3][1], 1, "s") for i in range(200, 260)]  # one vector many times
    rows += [(i, [0.0] * 7, 1, "s") for i in range(300, 320)]
    rows += [(400, None, 1, "s"), (405, [float("nan")] * 7, 1, "s"), (410, [None] + [1.0] * 6, 1, "s"), (None, [1.0] * 7, 1, "s"),
             (415, [float("inf")] * 7, 1, "s"), rows[0], (420, [1.0, 2.0], 1, "s"), (425, [], 1, "s")]
    assert found(spark, rows, 5, 5, lists=lists) == brute_force([r[:2] for r in rows], 5, 5)


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_ids_shared_by_different_vectors(spark, lists, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(9)
    rows = [(i % 40, [float(np.float32(x)) for x in rng.normal(size=6)], 1, "s") for i in range(160)]
    rows += [(i, rows[0][1], 1, "s") for i in (0, 5, 7, 7, 50)]
    assert found(spark, rows, 4, 5, lists=lists) == brute_force([r[:2] for r in rows], 4, 5)


def test_fewer_candidates_than_k_and_empty_tables(spark):
    rows = [(0, [1.0], 1, "s"), (1, [2.0], 1, "s"), (2, [-2.0], 1, "s")]
    assert found(spark, rows, 5, 2) == brute_force([r[:2] for r in rows], 5, 2)
    assert found(spark, rows[:1], 5, 2) == []
    assert found(spark, [], 5, 2) == []


def test_scores_that_do_not_fit_a_long_are_an_error(spark):
    rows = [(i, [float(i), 1.0], 1, "s") for i in range(10)]
    for huge in (1e18, -3e38, 1e7):
        with pytest.raises(topk.ScoresTooLarge):
            found(spark, [*rows, (11, [huge, 1.0], 1, "s")], 5, 5)
    assert found(spark, [*rows, (11, [5e6, 1.0], 1, "s")], 5, 5) == brute_force([r[:2] for r in [*rows, (11, [5e6, 1.0])]], 5, 5)


def test_blocks_are_bounded_and_whole(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    asked = spark.range(0, 100, 1, 3).selectExpr("id as row", "id", "array(id) as vector")
    blocks = [[r.row for r in block.collect()] for block in topk._query_blocks(asked)]
    assert sorted(sum(blocks, [])) == list(range(100)) and max(map(len, blocks)) <= 16


def test_the_higher_cutoff_keeps_every_tie(spark):
    # Scores come from one list or the other, so many candidates lack an entry and tie at the cutoff.
    rows = [(0, [1.0, 1.0], 1, "s")]
    rows += [(k, [3.0, 0.0] if k % 3 else [0.0, 3.0] if k % 2 else [1.5, 1.5], 1, "s") for k in range(1, 60)]
    for k in (1, 5, 20):
        assert found(spark, rows, k, 50) == brute_force([r[:2] for r in rows], k, 50)


def test_query_equals_the_statement(spark, data):
    assert differences(QUERIES["op7_exact_top_k"](spark, data), connect(data), ORACLE_SQL["op7_exact_top_k"]) == []
