"""Audit of how document filters interact, over a sparse document-term matrix.

The matrix is built in three steps. Tasks cut the documents into shards, give the words of a shard
local numbers and write one sparse row per document. The distinct words of all shards are numbered
once, globally. Each shard then meets the global numbers of its own words and becomes a CSR block:
row borders, global word numbers, counts. A row's sum is its number of words and its nonzero
entries are its distinct words, which decide the first two filters. A word is shuffled once per
shard that holds it, however often it stands there, so frequent words are not hot.

The other filters look at the text itself or at its digest (128 bits of SHA-256). What a document
fails is a set of five bits, and everything the report says is a sum over counts of such sets.

Null texts are empty, null languages the empty string. Rows with a repeated doc_id are counted each
by itself and are never copies of each other; a row with a null doc_id is nobody's copy and has no
labels. A document has a label when any of its label rows says so. No documents give no rows.
Further columns are left out.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlane.functions.durable import drop_durable, durable
from ledgerlane.llm.words import encoded, word_blocks

LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"
FILTERS = "ABCDE"

#: Nonzero entries after which a shard is closed. A shard is one task's memory: about 40 bytes an entry.
SHARD_ENTRIES = 1 << 22

_CAPITALS = bytes(range(65, 91))

CELLS = pa.schema(
    [
        ("shard", pa.int64()),
        ("row", pa.int32()),
        ("doc_id", pa.int64()),
        ("part", pa.string()),
        ("digest", pa.binary()),
        ("fails", pa.int32()),
        ("columns", pa.binary()),
        ("counts", pa.binary()),
        ("word", pa.binary()),
    ]
)
CELLS_SQL = (
    "shard long, row int, doc_id long, part string, digest binary, fails int, columns binary, counts binary, word binary"
)


def _bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def _text_bits(text: str, data: bytes) -> int:
    """The filters that look at characters."""
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    fails = _bit("C") if 100 * capitals > CAPITAL_PERCENT * len(text) else 0
    return fails | (_bit("D") if len(data.translate(None, SYMBOLS)) < len(data) else 0)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse rows with local column numbers, and after the rows of a shard its words: ``row`` is the local number.
    A word's local number is the count of the shard's entries before its first one."""
    task = TaskContext.get().partitionId()
    number, entries, local, rows, ticks = 0, 0, {}, [], itertools.count()

    def shard() -> Iterator[pa.RecordBatch]:
        own = [(task << 32) | number]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own * len(rows), pa.int64()), pa.array(range(len(rows)), pa.int32())]
            + [pa.array(list(column), CELLS.field(k + 2).type) for k, column in enumerate(zip(*rows))]
            + [pa.nulls(len(rows), pa.binary())],
            schema=CELLS,
        )
        words, places = list(local), pa.array(local.values(), pa.int32())
        empty = [pa.nulls(len(words), CELLS.field(k).type) for k in range(2, 8)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own * len(words), pa.int64()), places, *empty, pa.array(words, pa.binary())],
            schema=CELLS,
        )

    for batch in batches:
        for doc_id, part, text in zip(*(column.to_pylist() for column in batch.columns)):
            data, counts = encoded(text), Counter()
            for block in word_blocks(data):
                counts.update(block)
            columns = np.fromiter(map(local.setdefault, counts, ticks), "<i4", len(counts))
            values = np.fromiter(counts.values(), "<i4", len(counts))
            digest = hashlib.sha256(data).digest()[:16]
            rows.append((doc_id, part, digest, _text_bits(text or "", data), columns.tobytes(), values.tobytes()))
            entries += len(counts)
            if entries >= SHARD_ENTRIES:
                yield from shard()
                number, entries, local, rows, ticks = number + 1, 0, {}, [], itertools.count()
    if rows:
        yield from shard()


def sparse_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang") -> DataFrame:
    """Documents as sparse rows over local word numbers, and the words of each shard; written once."""
    own = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_column), F.lit("")).alias("part"),
        F.col(text_column).alias("text"),
    )
    return durable(own.mapInArrow(_cells, CELLS_SQL), "audit-cells")


def word_places(cells: DataFrame) -> DataFrame:
    """Where the words of all shards come to stand, written once: shard (``holder``), local number, and the place
    among the distinct words of one task. The first row of a word carries the word itself.

    Words are shuffled once and numbered as they pass by in order; the numbers of tasks are put one behind
    the other in ``_numbered``.
    """
    words = cells.where("word is not null").select(F.col("shard").alias("holder"), F.col("row").alias("local"), "word")
    names = ["holder", "local", "word", "task", "place"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()])))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, next_place = TaskContext.get().partitionId(), pa.nulls(1, pa.binary()), 0
        for batch in batches:
            if batch.num_rows:
                own = batch.column(2)
                before = pa.concat_arrays([last, own[:-1]])
                new = pc.fill_null(pc.not_equal(own, before), True)
                places = next_place - 1 + np.cumsum(new.to_numpy(zero_copy_only=False), dtype=np.int64)
                last, next_place = own[-1:], int(places[-1]) + 1
                firsts = pc.if_else(new, own, pa.scalar(None, pa.binary()))
                tasks = pa.array(np.full(len(own), task, "<i4"))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], firsts, tasks, pa.array(places)], schema=schema)

    ordered = words.repartition("word").sortWithinPartitions("word")
    return durable(ordered.mapInArrow(number, "holder long, local int, word binary, task int, place long"), "audit-words")


def _numbered(places: DataFrame) -> DataFrame:
    """Places with the word's number in the whole dictionary, from 0 on without gaps. There is one start per task."""
    sizes = places.groupBy("task").agg((F.max("place") + 1).alias("n"))
    before = F.sum("n").over(W.orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("task", F.coalesce(before, F.lit(0)).alias("start"))
    return places.join(F.broadcast(starts), "task").withColumn("number", F.col("start") + F.col("place"))


def dictionary(places: DataFrame) -> DataFrame:
    """(word, number) of every distinct word."""
    return _numbered(places).where("word is not null").select("word", "number")


def _block(cells: pa.Table, words: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row borders, global column numbers and counts of one shard."""
    places = words["local"].to_numpy()
    numbers = np.empty(places.max(initial=-1) + 1, "<i8")
    numbers[places] = words["number"].to_numpy()
    columns = [np.frombuffer(c, "<i4") for c in cells["columns"].to_pylist()]
    borders = np.concatenate([[0], np.cumsum([len(c) for c in columns], dtype=np.int64)])
    counts = np.frombuffer(b"".join(cells["counts"].to_pylist()), "<i4")
    return borders, numbers[np.concatenate(columns)], counts


def _with_numbers(cells: DataFrame, places: DataFrame):
    """Shards beside the global numbers of their words, grouped by shard."""
    rows = cells.where("word is null").drop("word")
    return rows.groupBy("shard").cogroup(_numbered(places).select("holder", "local", "number").groupBy("holder"))


def csr_shards(cells: DataFrame, places: DataFrame) -> DataFrame:
    """The matrix: per shard its documents, row borders, global word numbers and counts."""
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
    schema = pa.schema(list(zip(["shard", "doc_ids", "borders", "columns", "counts"], kinds)))

    def build(rows: pa.Table, words: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        borders, columns, counts = _block(rows, words)
        shard = [rows["shard"][0].as_py()]
        lists = [rows["doc_id"].to_pylist(), borders, columns, counts]
        return pa.table([pa.array(shard, kinds[0]), *(pa.array([v], k) for v, k in zip(lists, kinds[1:]))], schema=schema)

    sql = "shard long, doc_ids array<long>, borders array<long>, columns array<long>, counts array<int>"
    return _with_numbers(cells, places).applyInArrow(build, sql)


def matrix_flags(cells: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, part, digest, fails): filters A and B from sums and nonzero entries of the CSR rows, beside C and D."""
    kept = ["doc_id", "part", "digest", "fails"]
    schema = pa.schema([CELLS.field(name) for name in kept])

    def decide(rows: pa.Table, words: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        borders, _, counts = _block(rows, words)
        sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        total, distinct = np.diff(sums[borders]), np.diff(borders)
        few = np.where(total < LEAST_WORDS, _bit("A"), 0)
        repeated = np.where(100 * distinct < DISTINCT_PERCENT * total, _bit("B"), 0)
        fails = (rows["fails"].to_numpy() | few | repeated).astype("int32")
        return pa.table([*(rows[name] for name in kept[:3]), pa.array(fails)], schema=schema)

    return _with_numbers(cells, places).applyInArrow(decide, "doc_id long, part string, digest binary, fails int")


def failed_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, part, fails (bit k for the k-th filter), good, toxic."""
    cells = sparse_rows(docs)
    places = word_places(cells)
    rows = durable(matrix_flags(cells, places), "audit-rows")
    drop_durable(cells, places)
    # Rows that hold the smallest doc_id of their text are no copies; looked up by id too, so no text is a hot key.
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = labels.groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    copied = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (
        rows.join(firsts, ["digest", "doc_id"], "left")
        .join(marked, "doc_id", "left")
        .select(
            "doc_id",
            "part",
            F.col("fails").bitwiseOR(F.when(copied, _bit("E")).otherwise(0)).alias("fails"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )


def _bits(letters: Column) -> Column:
    """Letters of filters as bits."""
    return F.aggregate(
        F.split(letters, ""),
        F.lit(0),
        lambda bits, x: bits.bitwiseOR(F.when(x == "", 0).otherwise(F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), x) - 1))),
    )


def interactions(failed: DataFrame) -> DataFrame:
    """The report over all orders of the filters; takes the result of ``failed_filters``.

    A document that fails k filters is removed by a given one of them in 1/k of all orders, which makes
    the sum over orders a whole number per document.
    """
    orders = ["".join(order) for order in itertools.permutations(FILTERS)]
    sets = failed.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    places = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    steps = (
        sets.withColumn("filter_order", F.explode(F.lit(orders)))
        .withColumn("step", F.explode(places))
        .withColumn("before", _bits(F.expr("left(filter_order, step - 1)")))
        .withColumn("own", _bits(F.expr("substr(filter_order, step, 1)")))
    )
    fails_own = F.col("fails").bitwiseAND(F.col("own")) != 0
    earlier = F.col("fails").bitwiseAND(F.col("before")) != 0
    here = fails_own & ~earlier

    def total(condition: Column, amount: Column | str = "n") -> Column:
        return F.sum(F.when(condition, amount if isinstance(amount, Column) else F.col(amount)).otherwise(0))

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails_own & ~earlier).alias("kept"),
        total(here).alias("removed"),
        total(fails_own & earlier).alias("redundant"),
        total(F.col("fails") == F.col("own")).alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        total(fails_own, F.col("n") * F.expr(f"{len(orders)} div bit_count(fails)")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(failed_filters(docs, labels))


ORACLE_SQL = r"""
with recursive docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents
), words as (
  select doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from docs
), firsts as (
  select text, min(doc_id) as first_id from docs group by text
), marked as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
), failed as (
  select part,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: case f
      when 'A' then len(w) < 200
      when 'B' then 100 * len(list_distinct(w)) < 50 * len(w)
      when 'C' then 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text)
      when 'D' then regexp_matches(text, '[#$%&*|]')
      else coalesce(doc_id > first_id, false) end) as fails,
    coalesce(good, false) as good, coalesce(toxic, false) as toxic
  from words join firsts using (text) left join marked using (doc_id)
), sets as (
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from failed group by all
), orders as (
  select '' as filter_order
  union all
  select filter_order || f from orders, unnest(['A', 'B', 'C', 'D', 'E']) as l(f) where not contains(filter_order, f)
), steps as (
  select part, fails, n, good, toxic, filter_order, step::int as step, filter_order[step] as own,
    list_has_any(fails, string_split(left(filter_order, step - 1), '')) as earlier
  from sets, orders, range(1, 6) as r(step) where length(filter_order) = 5
)
select part, filter_order, step,
  coalesce(sum(n) filter (not contains(fails, own) and not earlier), 0)::bigint as kept,
  coalesce(sum(n) filter (contains(fails, own) and not earlier), 0)::bigint as removed,
  coalesce(sum(n) filter (contains(fails, own) and earlier), 0)::bigint as redundant,
  coalesce(sum(n) filter (fails = [own]), 0)::bigint as unique_fails,
  coalesce(sum(good) filter (contains(fails, own) and not earlier), 0)::bigint as good_lost,
  coalesce(sum(toxic) filter (contains(fails, own) and not earlier), 0)::bigint as toxic_lost,
  coalesce(sum(n * (120 // nullif(len(fails), 0))) filter (contains(fails, own)), 0)::bigint as shapley
from steps group by part, filter_order, step
"""
