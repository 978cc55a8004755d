"""Exact top-k by inner product, with a uniform threshold in three phases.

A vector becomes integers, floor(256 * x). Its dimensions are dealt over ``LISTS`` lists; in each
list a candidate has a partial score, and its score is the sum over the lists.

1. Every task gives its best k partial scores per query and list. The best k of each list name up to
   k * LISTS candidates per query, whose exact scores give a cutoff: the k-th highest.
2. The cutoff is broadcast. A candidate that reaches it has, in some list, at least an equal share of
   it, so every entry with that share is collected, and no other candidate can be among the top k.
3. Collected candidates with all entries have their score, and the k-th highest of these is a higher
   cutoff. A candidate that lacks entries has at most its entries and just below the share for each one
   missing; where that stays below the higher cutoff it is dropped. The rest is resolved from the
   vectors.

Queries go in blocks of bounded size, each block against all candidates. At most k + 1 of equal
vectors can be in any result, the ones with the smallest ids, so the others need no scores.

Every distinct row of id and vector has a number, by which queries and candidates are told apart all
the way; ids come back at the end. Vectors that are null, or hold null or non-finite components, or have no id, take no part. A shorter
vector counts as ending in zeros, and an empty one scores 0. Rows that repeat both id and vector
count once; rows that share only the id are candidates of their own, and are never candidates for a
query of that id. Ties go to the smaller vec_id. An empty table gives an empty result.

Scores are longs. By the inequality of Cauchy and Schwarz no score is beyond the largest squared
length of a vector; where that does not fit a long the search raises ``ScoresTooLarge`` before it begins,
rather than give wrong ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions.durable import drop_durable, durable

SCALE = 256
LISTS = 2
#: Queries of a block: about QUERY_BLOCK, never over twice as many.
QUERY_BLOCK = 1024
#: Largest squared length of a vector: all scores, and all sums on the way to them, stay below 2^62.
LARGEST = float(1 << 62)
ROWS_AT_ONCE = 2048
TIE_SALTS = 16


class ScoresTooLarge(ValueError):
    """Vectors are so long that scores may not fit a long."""


ENTRY_SCHEMA = "query long, list int, candidate long, vec_id long, partial long"
ENTRY_NAMES = ["query", "list", "candidate", "vec_id", "partial"]


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Distinct (id, vector) of the rows that take part; ids as longs. Components beyond a long end at its limits."""
    finite = F.forall(vector_column, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    scaled = F.transform(vector_column, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))
    known = F.col(id_column).isNotNull() & F.col(vector_column).isNotNull()
    return (
        vectors.where(known & finite).select(F.col(id_column).cast("long").alias("id"), scaled.alias("vector")).distinct()
    )


def _without_surplus_ties(rows: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` smallest ids of each vector; within salts first, so that no task gets all of a vector."""
    salt = F.pmod(F.xxhash64("id"), F.lit(TIE_SALTS))
    for group in (["vector", "salt"], ["vector"]):
        order = Window.partitionBy(*group).orderBy("id")
        rows = rows.withColumn("salt", salt).withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
        rows = rows.select("row", "id", "vector")
    return rows


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T; in floating point where that is exact."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), dtype=np.int64)
    largest = float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1]
    if largest < 2**53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


class _QueryBlock:
    """Queries whose vectors, and later cutoffs, every task gets."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, lists: int):
        self.rows, self.ids, self.vectors = rows, ids, vectors
        self.columns = np.array_split(np.arange(vectors.shape[1]), lists)

    def partials(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(list, candidate rows and ids, partial scores by query, whether they count) of every few candidates."""
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                own = np.stack([part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)])
                matrix = _matrix(part.column(2), self.vectors.shape[1])
                others = self.ids[:, None] != own[1][None, :]
                for k, columns in enumerate(self.columns):
                    yield k, own, _products(self.vectors[:, columns], matrix[:, columns]), others

    def entries(self, place: int, own: np.ndarray, scores: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
        q, c = np.nonzero(wanted)
        lists = np.full(len(q), place, dtype=np.int32)
        columns = [pa.array(x) for x in (self.rows[q], lists, own[0][c], own[1][c], scores[q, c])]
        return pa.RecordBatch.from_arrays(columns, names=ENTRY_NAMES)

    def best_entries(self, candidates: DataFrame, k: int) -> DataFrame:
        """Of every few candidates the k best partial scores per query and list."""

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for place, own, scores, others in self.partials(batches):
                wanted = others.copy()
                if own.shape[1] > k + 1:
                    ranked = np.where(others, scores, np.iinfo(np.int64).min)
                    wanted = np.zeros_like(others)
                    np.put_along_axis(wanted, np.argpartition(-ranked, k - 1, axis=1)[:, :k], True, axis=1)
                    wanted &= others
                yield self.entries(place, own, scores, wanted)

        return candidates.select("row", "id", "vector").mapInArrow(search, ENTRY_SCHEMA)

    def entries_from(self, candidates: DataFrame, cutoffs: np.ndarray) -> DataFrame:
        """All entries that reach an equal share of their query's cutoff."""
        lists = len(self.columns)
        share = -(-cutoffs // lists)  # the smallest integer at or above cutoff / lists

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for place, own, scores, others in self.partials(batches):
                yield self.entries(place, own, scores, others & (scores >= share[:, None]))

        return candidates.select("row", "id", "vector").mapInArrow(search, ENTRY_SCHEMA)


def _inner_product(left: str, right: str) -> Column:
    terms = F.zip_with(left, right, lambda x, y: F.coalesce(x * y, F.lit(0).cast("long")))
    return F.aggregate(terms, F.lit(0).cast("long"), lambda total, term: total + term)


def _resolved(pairs: DataFrame, queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """The exact score of (query, candidate) pairs. Queries are a block's, so they are few enough to send."""
    asked = F.broadcast(queries.select(F.col("row").alias("query"), F.col("vector").alias("query_vector")))
    given = candidates.select(F.col("row").alias("candidate"), F.col("id").alias("vec_id"), "vector")
    scored = pairs.join(given, "candidate").join(asked, "query")
    return scored.select("query", "candidate", "vec_id", _inner_product("query_vector", "vector").alias("score"))


def _first(rows: DataFrame, group: list[str], score: str, k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc(score), "vec_id", "candidate")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _higher_cutoffs(whole: DataFrame, queries: np.ndarray, cutoffs: np.ndarray, k: int, lists: int) -> DataFrame:
    """(query, share, cutoff): what an entry had to reach, and the k-th highest score known by now. One row per
    query of the block."""
    known = _first(whole, ["query"], "score", k).groupBy("query").agg(F.min("score").alias("later"), F.count("*").alias("n"))
    first = whole.sparkSession.createDataFrame(
        [(int(q), int(-(-c // lists)), int(c)) for q, c in zip(queries, cutoffs)], "query long, share long, first long"
    )
    higher = F.when(F.col("n") == k, F.greatest("first", "later")).otherwise(F.col("first"))
    return first.join(known, "query", "left").select("query", "share", higher.alias("cutoff"))


def _query_blocks(asked: DataFrame) -> list[DataFrame]:
    """The queries in blocks of at most twice QUERY_BLOCK, by their place in equal parts of the table."""
    parts = max(1, -(-asked.count() // QUERY_BLOCK))
    placed = asked.repartition(parts).withColumn("place", F.monotonically_increasing_id())
    within = F.col("place").bitwiseAND((1 << 33) - 1)
    blocks = (F.shiftright("place", 33) * (1 << 20)) + F.floor(within / (2 * QUERY_BLOCK))
    dealt = durable(placed.select("row", "id", "vector", blocks.alias("block")), "topk-blocks")
    numbers = sorted(r.block for r in dealt.select("block").distinct().collect())
    return [dealt.where(F.col("block") == number).drop("block") for number in numbers]


def _top_k_of_block(queries: DataFrame, candidates: DataFrame, width: int, k: int, lists: int) -> DataFrame:
    rows = queries.toPandas()
    vectors = _matrix(pa.array(list(rows["vector"]), pa.list_(pa.int64())), width)
    block = _QueryBlock(rows["row"].to_numpy(dtype=np.int64), rows["id"].to_numpy(dtype=np.int64), vectors, lists)
    # Phase 1: local lists, and from their best candidates a safe cutoff.
    named = _first(block.best_entries(candidates, k), ["query", "list"], "partial", k).select("query", "candidate").distinct()
    leaders = _first(_resolved(named, queries, candidates), ["query"], "score", k)
    cutoff_rows = leaders.groupBy("query").agg(F.min("score").alias("cutoff"), F.count("*").alias("n")).toPandas()
    lowest = np.iinfo(np.int64).min // 2
    known = {q: c for q, c, n in cutoff_rows.itertuples(index=False) if n == k}
    cutoffs = np.array([known.get(q, lowest) for q in block.rows.tolist()], dtype=np.int64)
    # Phase 2: every entry that reaches its share of the cutoff.
    collected = durable(
        block.entries_from(candidates, cutoffs)
        .groupBy("query", "candidate", "vec_id")
        .agg(F.sum("partial").alias("score"), F.count("*").alias("n")),
        "topk-collected",
    )
    # Phase 3: the scores of candidates that lack an entry and can still be among the best.
    whole = collected.where(F.col("n") == lists).select("query", "candidate", "vec_id", "score")
    limits = _higher_cutoffs(whole, block.rows, cutoffs, k, lists)
    most = F.col("score") + (lists - F.col("n")) * (F.col("share") - 1)
    lacking = collected.where(F.col("n") < lists).join(F.broadcast(limits), "query")
    partly = _resolved(lacking.where(most >= F.col("cutoff")).select("query", "candidate"), queries, candidates)
    asked = queries.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    best = _first(whole.union(partly), ["query"], "score", k)
    found = durable(best.join(asked, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "topk-found")
    drop_durable(collected)
    return found


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    lists: int = LISTS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of every query.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    # The numbers hold because they are written before anything reads them.
    distinct = integer_vectors(vectors, id_column, vector_column)
    rows = durable(distinct.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    asked = rows.where(is_query)
    square = F.aggregate(F.transform("vector", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, b: a + b)
    width, longest = rows.agg(F.max(F.size("vector")), F.max(square)).first()
    if (longest or 0) >= LARGEST:
        raise ScoresTooLarge(f"a vector has a squared length of {longest:.3g} after scaling; scores must stay below {LARGEST:.3g}")
    candidates = durable(_without_surplus_ties(rows, k + 1), "topk-candidates")
    found = [_top_k_of_block(own, candidates, width, k, lists) for own in _query_blocks(asked)] if width is not None else []
    if not found:
        return rows.limit(0).select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")
        )
    return spark.read.schema(found[0].schema).parquet(*(f._durable_path for f in found))
