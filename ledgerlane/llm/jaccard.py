"""Documents that share nearly all their word shingles, by size-banded tiles and bitmap signatures.

A document's set holds 64-bit hashes of its distinct shingles. Equal sets are one class from then on.
Sizes are cut into bands, so that a set's partners lie in its own band and the next. Two sets within
a band's reach differ in at most d shingles; the hash range is cut into d + 1 parts, so at least one
part is the same in both. A tile holds the sets of a band's reach that agree in one part: a set
enters the tiles of its own band and, as the larger one, of the band below. Since a part holds some
nine shingles, passages that many documents share make no large tiles.

In a tile a pair is first bounded from above: bits that one bitmap has beyond the other are shingles
that the overlap lacks. Pairs that the bound lets through are intersected exactly.

Components need not test every pair. All sets of a tile are tested against its first and its last
one, which joins copies of one text in linear time; then only tiles with more than one component are
compared in blocks, and only pairs across components. ``similar_pairs`` compares all tiles in full.

Null texts and texts without words have an empty set, which is linked with nothing; their component
is their own id. Rows with a repeated or null doc_id keep their own row; a component without any
doc_id has a null id. An empty table gives no rows. Further columns are left out.
"""

from __future__ import annotations

import functools
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlane.functions.durable import drop_durable, durable
from ledgerlane.functions.groups import first_per_group
from ledgerlane.llm.components import connected_components
from ledgerlane.llm.words import LOWER, encoded, word_blocks

SHINGLE_WORDS = 3
PERCENT = 90
#: Rows of a block; a tile of more rows is compared block by block, in as many tasks as there are pairs of blocks.
BLOCK_ROWS = 1024
#: Bits of the filter of documents to read again: eight for each, within these bounds.
FILTER_BITS = (1 << 16, 1 << 26)

_U8 = np.dtype("<u8")


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` word hashes."""
    count = len(words) - width + 1
    state = _mixed(words[:count] + np.uint64(width))
    for k in range(1, width):
        state = _mixed(state + words[k : count + k])
    return state


def shingle_hashes(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of fewer words than a shingle has, the whole sequence's."""
    carried, found = np.empty(0, _U8), []
    for block in word_blocks(encoded(text).translate(LOWER)):
        words = np.concatenate([carried, np.fromiter(map(xxhash.xxh3_64_intdigest, block), _U8, len(block))])
        if len(words) >= width:
            found.append(np.unique(_runs(words, width)))
        carried = words[len(words) - min(width - 1, len(words)) :]
    if found:
        return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
    return _runs(carried, len(carried)) if len(carried) else carried


def _most_differing(sizes: int, percent: int) -> int:
    """In how many shingles two sets of that size together can differ and still be linked."""
    return sizes * (100 - percent) // (100 + percent)


@functools.cache
def _band_tops(most: int, percent: int) -> tuple[int, ...]:
    """Largest size of every band, up to the one that holds ``most`` (rounded up by the caller)."""
    tops = [1]
    while tops[-1] < most:
        tops.append(max(tops[-1] + 1, 100 * tops[-1] // percent))
    return tuple(tops)


def _part_keys(hashes: np.ndarray, band: int, top: int, percent: int) -> np.ndarray:
    """One key per part of the hash range: of the part's hashes, the part and the band. None where only
    equal sets are linked."""
    parts = _most_differing(top + 100 * top // percent, percent) + 1
    if parts == 1:
        return np.empty(0, "<i8")
    edges = np.arange(1, parts, dtype=_U8) * np.uint64((1 << 64) // parts)
    borders = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])
    sums = np.concatenate([np.zeros(1, _U8), np.cumsum(_mixed(hashes + np.uint64(1)), dtype=_U8)])
    own = sums[borders[1:]] - sums[borders[:-1]]
    place = np.arange(parts, dtype=_U8) + (np.uint64(band) << np.uint64(32))
    return _mixed(own + _mixed(place)).view("<i8")


def tile_keys(hashes: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the tiles of the set's own band, and of the band below."""
    none = np.empty(0, "<i8")
    if not len(hashes):
        return none, none
    tops = _band_tops(1 << len(hashes).bit_length(), percent)
    band = bisect_left(tops, len(hashes))
    own = _part_keys(hashes, band, tops[band], percent)
    return own, _part_keys(hashes, band - 1, tops[band - 1], percent) if band else none


SETS_SQL = "doc_id long, n int, set_key binary, own array<long>, below array<long>"
SETS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int32()), ("set_key", pa.binary())] + [(c, pa.list_(pa.int64())) for c in ("own", "below")]
)


def _set_key(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def _in_parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Size, 128-bit key and tile keys of every document's set, with a number per row; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_parts(batches):
            sets = [shingle_hashes(text, width) for text in part.column(1).to_pylist()]
            keys = [tile_keys(hashes, percent) for hashes in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(hashes) for hashes in sets], pa.int32()),
                    pa.array([_set_key(hashes) for hashes in sets], pa.binary()),
                    *(pa.array([pair[k] for pair in keys], pa.list_(pa.int64())) for k in range(2)),
                ],
                schema=SETS,
            )

    return durable(docs.mapInArrow(run, SETS_SQL).withColumn("row", F.monotonically_increasing_id()), "jaccard-sets")


def _tiles(sets: DataFrame) -> DataFrame:
    """(key, row, m): tiles of several classes, each once. A tile without a set of its own band is left out, as
    its pairs meet in the band above; so is one that holds the same classes as another."""
    first = first_per_group(sets.where("set_key is not null").select("set_key", "row", "own", "below"), ["set_key"], [F.col("row")])
    entries = first.select("row", F.lit(True).alias("home"), F.explode("own").alias("key")).union(
        first.select("row", F.lit(False), F.explode("below"))
    )
    tile = W.partitionBy("key")
    shared = (
        entries.withColumn("m", F.count("*").over(tile))
        .withColumn("home", F.max("home").over(tile))
        .where("m > 1 and home")
        .select("key", "row", "m")
    )
    tiles = durable(shared, "jaccard-tiles")
    members = tiles.groupBy("key").agg(
        F.first("m").alias("m"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y")
    )
    kept = members.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key")
    distinct = durable(tiles.join(kept, "key"), "jaccard-tiles")
    drop_durable(tiles)
    return distinct


def _filter_of(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap over hashes of ``doc_id``, of bounded size, and the number of its bits."""
    count = ids.count()
    bits = min(max(1 << (8 * count).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    slot = _slot(bits)
    words = ids.select(F.shiftright(slot, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int")).alias("bit"))
    held = np.zeros(bits >> 6, "<i8")
    for word, bit in words.groupBy("word").agg(F.bit_or("bit")).collect():
        held[word] = bit
    return held.view(_U8), bits


def _slot(bits: int):
    """Null ids are hashed like any other."""
    return F.xxhash64("doc_id").bitwiseAND(bits - 1)


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    """A bit per hash, in at least four times as many bits, a power of two of them and 64 at least."""
    bits = 1 << max(6, (4 * len(hashes) - 1).bit_length())
    places = hashes & np.uint64(bits - 1)
    flags = np.zeros(bits, bool)
    flags[places.astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(_U8)


def _folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    """The bitmap of the same hashes in fewer bits."""
    return np.bitwise_or.reduce(bitmap.reshape(-1, words), axis=0)


def _least_overlap(sizes: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shingles that two sets of that size together must share."""
    return -(-percent * sizes // (100 + percent))


def _may_link(n: int, bitmap: np.ndarray, others: np.ndarray, bitmaps: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets (sizes ``others``, one bitmap a row, all as wide as ``bitmap``) may share enough."""
    lacks = np.bitwise_count(bitmap & ~bitmaps).sum(axis=1, dtype=np.int64)
    beyond = np.bitwise_count(bitmaps & ~bitmap).sum(axis=1, dtype=np.int64)
    return np.minimum(n - lacks, others - beyond) >= _least_overlap(n + others, percent)


def _links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on sorted hashes."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= _least_overlap(len(a) + len(b), percent)


def _signatures(docs: DataFrame, sets: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(row, n, bitmap, hashes) of the classes in ``rows``: their documents are read again, through a filter on
    their ids, and only they are shuffled. Written once."""
    wanted = durable(sets.select("row", "doc_id", "set_key").join(rows, "row"), "jaccard-wanted")
    held, bits = _filter_of(wanted.select("doc_id"))
    shared = docs.sparkSession.sparkContext.broadcast(held)
    kinds = [pa.int64(), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip(["doc_id", "set_key", "hashes"], kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_parts(batches):
            slots = part.column(2).to_numpy()
            hit = (shared.value[slots >> 6] >> (slots & 63).astype(_U8)) & np.uint64(1)
            part = part.filter(pa.array(hit.astype(bool)))
            found = [shingle_hashes(text, width) for text in part.column(1).to_pylist()]
            columns = [part.column(0), [_set_key(h) for h in found], [h.tobytes() for h in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema=schema)

    again = docs.withColumn("slot", _slot(bits)).mapInArrow(run, "doc_id long, set_key binary, hashes binary")
    same = (again["set_key"] == wanted["set_key"]) & again["doc_id"].eqNullSafe(wanted["doc_id"])
    known = again.join(wanted, same).select("row", "hashes")

    @F.pandas_udf("binary")
    def bitmap(hashes: pd.Series) -> pd.Series:
        return pd.Series([_bitmap(np.frombuffer(h, _U8)).tobytes() for h in hashes])

    once = known.groupBy("row").agg(F.first("hashes").alias("hashes"))  # equal rows of one id give equal hashes
    size = (F.octet_length("hashes") / 8).cast("int").alias("n")
    signatures = durable(once.select("row", size, bitmap("hashes").alias("bitmap"), "hashes"), "jaccard-signatures")
    drop_durable(wanted)
    return signatures


def _beside(pairs: DataFrame, signatures: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the signature columns of both, as ``a_…`` and ``b_…``."""
    for side in ("a", "b"):
        named = signatures.select(F.col("row").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns))
        pairs = pairs.join(named, side)
    return pairs


def _bounded(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs that their bitmaps let through."""

    @F.pandas_udf("boolean")
    def may(a: pd.Series, a_n: pd.Series, b: pd.Series, b_n: pd.Series) -> pd.Series:
        found = []
        for x, x_n, y, y_n in zip(a, a_n, b, b_n):
            x, y = np.frombuffer(x, _U8), np.frombuffer(y, _U8)
            words = min(len(x), len(y))
            found.append(_may_link(x_n, _folded(x, words), np.array([y_n]), _folded(y, words)[None], percent)[0])
        return pd.Series(found, dtype=bool)

    return _beside(pairs, signatures, ["n", "bitmap"]).where(may("a_bitmap", "a_n", "b_bitmap", "b_n")).select("a", "b")


def _verified(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked."""

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_links(np.frombuffer(x, _U8), np.frombuffer(y, _U8), percent) for x, y in zip(a, b)], dtype=bool)

    return _beside(pairs, signatures, ["hashes"]).where(linked("a_hashes", "b_hashes")).select("a", "b")


def _star_pairs(tiles: DataFrame) -> DataFrame:
    """Every class of a tile beside the tile's first and its last one."""
    ends = tiles.groupBy("key").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    beside = tiles.join(ends, "key")
    pairs = beside.select(F.col("first").alias("a"), F.col("row").alias("b")).union(
        beside.select(F.col("row").alias("a"), F.col("last").alias("b"))
    )
    return pairs.where("a < b").distinct()


def _block_pairs(tiles: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs across components within the tiles (key, row, component, m) that their bitmaps let through."""
    blocks = F.ceil(F.col("m") / BLOCK_ROWS).cast("int")
    dealt = (
        tiles.withColumn("block", F.pmod(F.xxhash64("row", F.lit(2)), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "row", "component")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        low, block = table["low"][0].as_py(), table["block"].to_numpy()
        rows, components, sizes = (table[c].to_numpy() for c in ("row", "component", "n"))
        bitmaps = [np.frombuffer(b, _U8) for b in table["bitmap"].to_pylist()]
        words = min(map(len, bitmaps))
        matrix = np.stack([_folded(b, words) for b in bitmaps])
        same = table["high"][0].as_py() == low
        left = np.arange(len(rows)) if same else np.flatnonzero(block == low)
        right = left if same else np.flatnonzero(block != low)
        found = []
        for x in left:
            others = right[(components[right] != components[x]) & ((rows[right] > rows[x]) if same else True)]
            passed = others[_may_link(int(sizes[x]), matrix[x], sizes[others].astype(np.int64), matrix[others], percent)]
            found += [(min(rows[x], rows[y]), max(rows[x], rows[y])) for y in passed]
        return pa.table([pa.array([p[k] for p in found], pa.int64()) for k in range(2)], schema=schema)

    beside = dealt.join(signatures.select("row", "n", "bitmap"), "row")
    return beside.groupBy("key", "low", "high").applyInArrow(compare, "a long, b long").distinct()


def _own(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))


def similar_pairs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = SHINGLE_WORDS, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """All links between classes, (a, b), and the membership (doc_id, n_shingles, class_id); empty sets are in no class.
    Links grow with the square of a group of near copies; ``similar_components`` does not."""
    own = _own(docs, id_column, text_column)
    sets = _sets(own, width, percent)
    tiles = _tiles(sets)
    signatures = _signatures(own, sets, tiles.select("row").distinct(), width)
    apart = tiles.withColumn("component", F.col("row"))
    pairs = durable(_block_pairs(apart, signatures, percent), "jaccard-pairs")
    classes = sets.groupBy("set_key").agg(F.min("row").alias("class_id"))
    members = sets.join(classes, "set_key", "left").select(F.col("doc_id").alias(id_column), F.col("n").cast("long").alias("n_shingles"), "class_id")
    return durable(_verified(pairs, signatures, percent), "jaccard-links"), members


def _components(own: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """(row, component) of the classes that are linked with another."""
    tiles = _tiles(sets)
    signatures = _signatures(own, sets, tiles.select("row").distinct(), width)
    stars = durable(_bounded(_star_pairs(tiles), signatures, percent), "jaccard-pairs")
    links = durable(_verified(stars, signatures, percent), "jaccard-links")
    near = connected_components(links).withColumnRenamed("node", "row")

    # Tiles of two classes are settled by now.
    known = tiles.where("m > 2").join(near, "row", "left").withColumn("component", F.coalesce("component", "row"))
    mixed = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_tiles = durable(known.join(mixed.select("key"), "key"), "jaccard-open")
    tested = stars.select("a", "b", F.lit(True).alias("tested"))
    pairs = _block_pairs(open_tiles, signatures, percent).join(tested, ["a", "b"], "left_anti")
    tested_pairs = durable(pairs, "jaccard-pairs")
    across = durable(_verified(tested_pairs, signatures, percent), "jaccard-links")
    drop_durable(tiles, signatures, stars, links, open_tiles, tested_pairs)
    for side in ("a", "b"):
        end = near.select(F.col("row").alias(side), F.col("component").alias(f"{side}_component"))
        across = across.join(end, side, "left").withColumn(f"{side}_component", F.coalesce(f"{side}_component", side))
    joined = connected_components(across.select(F.col("a_component").alias("a"), F.col("b_component").alias("b")))

    merged = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    lone = joined.join(near, joined["node"] == near["row"], "left_anti").select(F.col("node").alias("row"), F.col("node").alias("component"))
    everyone = near.select("row", "component").unionByName(lone)
    result = everyone.join(merged, "component", "left").select("row", F.coalesce("whole", "component").alias("component"))
    return durable(result, "jaccard-components")


def similar_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable by links) and copies (rows
    with the same set)."""
    own = _own(docs, id_column, text_column)
    sets = _sets(own, width, percent)
    components = _components(own, sets, width, percent)
    classes = sets.where("set_key is not null").groupBy("set_key").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("first_id"), F.count("*").alias("copies")
    )
    known = classes.join(components, "row", "left").withColumn("component", F.coalesce("component", "row"))
    smallest = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = known.join(smallest, "component").select("set_key", "component_id", "copies")
    size = F.col("n").cast("long").alias("n_shingles")
    empty = sets.where("set_key is null").select(
        F.col("doc_id").alias(id_column), size, F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("copies")
    )
    filled = sets.join(named, "set_key").select(F.col("doc_id").alias(id_column), size, "component_id", "copies")
    return filled.union(empty)
