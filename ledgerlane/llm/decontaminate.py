"""Benchmark passages in training documents, found by spaced-seed hashing.

A token is a run of ASCII letters and digits and of characters beyond ASCII, other than marks and
spaces of the Latin-1 and General Punctuation blocks; A-Z and the capitals of Latin-1 are lower-cased.
A seed is a fixed mask over neighbouring tokens; tokens at its 0 positions are ignored, so a window with
substituted tokens there still has the hash of the original. Hashes of benchmark windows and
document windows are joined, and around every hit the two texts are compared token by token without
shifting: a document is contaminated when ``MIN_OVERLAP`` neighbouring tokens (the whole item, if it
is shorter) agree in at least ``MIN_AGREEMENT`` of the places.

A window of 15 tokens with up to three substitutions anywhere, as many as the comparison accepts, is
always hit; an overlap within a longer item has such a window. A shorter item is hashed whole, with masks
of its own length that leave a hit for as many substitutions as the comparison accepts: two from 10
tokens on, one from 5 on, none below. Items of fewer than ``SHORTEST_ITEM`` tokens say little about a
document, so they are looked for only on demand (``shortest_item``). Null and empty texts match nothing. Items with equal tokens are reported once, under
the smallest item_id, with their number.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.durable import durable
from ledgerlane.llm.memory import give_back
from ledgerlane.llm.tables import text_key, without_rows

MASKS = ["10011100111", "10100101111", "10100110111", "11000111101", "11011101001", "11110100011"]
SPAN = 11
MIN_OVERLAP = 15
MIN_AGREEMENT = 0.8
SHORTEST_ITEM = 5
#: Tokens kept on both sides of a hit, enough for any overlap that holds it.
MARGIN = MIN_OVERLAP
#: Bits of the filter that tells which document windows are worth shuffling: always 2 MB. Beyond
#: some millions of benchmark windows it lets more through, and the join alone decides.
FILTER_BITS = 1 << 24
#: Bytes of text whose tokens are looked at together.
BLOCK_BYTES = 1 << 19

_BYTE_CLASS = np.zeros(256, dtype=np.uint64)
for _c in range(256):
    _lower = _c + 32 if 65 <= _c <= 90 else _c
    if 48 <= _lower <= 57 or 97 <= _lower <= 122 or _lower > 127:
        _BYTE_CLASS[_c] = _lower + 1
_PRIME = np.uint64(0x100000001B3)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _classes(data: np.ndarray) -> np.ndarray:
    """The lower-cased bytes plus one, and 0 for bytes outside tokens."""
    classes = _BYTE_CLASS[data]
    after = np.append(data[1:], 0)
    capital = np.flatnonzero((data == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)) + 1
    classes[capital] += np.uint64(32)
    for first, width in ((data == 0xC2, 2), ((data == 0xE2) & ((after == 0x80) | (after == 0x81)), 3)):
        at = np.flatnonzero(first)
        for k in range(width):
            classes[np.minimum(at + k, len(data) - 1)] = 0
    return classes


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _PRIME)
    powers[:1] = 1
    return np.cumprod(powers)


_POWERS = _powers(64)


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every token of a text's UTF-8 bytes."""
    classes = _classes(data)
    inside = np.concatenate([[False], classes > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts, ends
    # A polynomial in the byte's place within its token; later places reuse the table with a factor.
    lengths = ends - starts
    offsets = np.cumsum(lengths) - lengths
    place = np.arange(offsets[-1] + lengths[-1]) - np.repeat(offsets, lengths)
    terms = classes[inside[1:-1]] * _POWERS[place & 63]
    if lengths.max() > 64:
        terms *= (1 + (place >> 6)).astype(np.uint64)
    hashes = np.add.reduceat(terms, offsets)
    return _mixed(hashes * _ODD + lengths.astype(np.uint64)), starts, ends


def window_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window, over the tokens at the mask's 1 positions."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, len(mask), dtype=np.uint64)
    for k, kept in enumerate(mask):
        if kept == "1":
            total = total * _PRIME + words[k : k + n]
    return _mixed(total)


@functools.cache
def item_masks(n: int) -> list[str]:
    """The masks for items of ``n`` tokens: for every choice of substituted places that still counts as overlap,
    one of them (below MIN_OVERLAP tokens) or of their shifts ignores all these places."""
    if n >= MIN_OVERLAP:
        return MASKS
    changes = max(c for c in range(n) if n - c >= MIN_AGREEMENT * n)
    if not changes:
        return ["1" * n]
    blocks = [frozenset(b) for b in itertools.combinations(range(n), n // 2 - 1)]
    left = {frozenset(c) for c in itertools.combinations(range(n), changes)}
    masks: list[str] = []
    while left:
        ignored = max(blocks, key=lambda block: sum(c <= block for c in left))
        left = {c for c in left if not c <= ignored}
        masks.append("".join("0" if k in ignored else "1" for k in range(n)))
    return masks


def _filter_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes % np.uint64(FILTER_BITS)).astype(np.int64), ((hashes >> np.uint64(32)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _passes(places: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the filter's bits, packed eight to a byte, are set."""
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & np.uint8(1) == 1


def _pieces(row: int, text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(row, first byte, piece) of a text. Most texts are one piece. Long ones are cut between tokens, and
    each piece begins so far back that every window and its margins lie within one of them."""
    start = 0
    while True:
        end = min(len(text), start + BLOCK_BYTES)
        while end < len(text) and _BYTE_CLASS[text[end]]:
            end += 1
        yield row, start, text[start:end]
        if end == len(text):
            return
        _, starts, _ = tokens(np.frombuffer(text[start:end], dtype=np.uint8))
        back = start + int(starts[-min(len(starts), SPAN + 2 * MARGIN)]) if len(starts) else end
        start = back if back > start else end


def _blocks(texts: pa.Array) -> Iterator[list[tuple[int, int, bytes]]]:
    """Pieces of neighbouring rows, about BLOCK_BYTES together."""
    block: list[tuple[int, int, bytes]] = []
    size = 0
    for row, text in enumerate(texts):
        for piece in _pieces(row, text.as_buffer().to_pybytes() if text.is_valid else b""):
            block.append(piece)
            size += len(piece[2])
            if size >= BLOCK_BYTES:
                yield block
                block, size = [], 0
    yield block


def _items(benchmark: DataFrame, id_column: str, text_column: str, shortest: int) -> DataFrame:
    """One row per distinct token sequence of at least ``shortest`` tokens: item_id, copies, words."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [
                tokens(np.frombuffer((t or "").encode("utf-8", "surrogatepass"), dtype=np.uint8))[0].view(np.int64)
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(words, pa.list_(pa.int64()))], names=["item_id", "words"]
            )

    items = benchmark.select(F.col(id_column).cast("long").alias("item_id"), text_column)
    return (
        items.mapInArrow(tokenise, "item_id long, words array<long>")
        .where(F.size("words") >= max(1, shortest))
        .groupBy("words")
        .agg(F.min("item_id").alias("item_id"), F.count("*").alias("item_copies"))
        .withColumn("item_key", F.xxhash64("words"))
    )


def _item_windows(items: DataFrame) -> DataFrame:
    """The seeds of the benchmark: mask, hash, item_key, item_at."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = row.values.to_numpy(zero_copy_only=False).view(np.uint64)
                for mask in item_masks(len(words)):
                    hashes = window_hashes(words, mask).view(np.int64)
                    n = len(hashes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([mask] * n, pa.string()), pa.array(hashes), pa.array([key] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32))],
                        names=["mask", "hash", "item_key", "item_at"],
                    )

    return items.select("item_key", "words").mapInArrow(cut, "mask string, hash long, item_key long, item_at int")


def _filter_bits(windows: DataFrame) -> np.ndarray:
    """The filter bits that the benchmark's hashes set, eight to a byte; gathered as FILTER_BITS / 64 longs at most."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = _filter_places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            both = np.unique(np.concatenate([first, second]))
            yield pa.RecordBatch.from_arrays([pa.array(both >> 6), pa.array((both & 63).astype(np.int32))], names=["word", "bit"])

    set_bits = windows.select("hash").mapInArrow(places, "word long, bit int")
    one = F.lit(1).cast("long")
    rows = set_bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toPandas()
    words = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    words[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return words.view(np.uint8)


def _seeded_regions(docs: DataFrame, bits: np.ndarray, short: list[int]) -> DataFrame:
    """Stretches of documents around windows that pass the filter.

    Columns: the key of the document, region (its first token's byte), words, starts and ends (bytes
    of the tokens), mask, hash, at (window's place in the region) as parallel arrays.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(bits)
    masks = [*MASKS, *(mask for n in short for mask in item_masks(n))]

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch.column(2)):
                out = list(_regions(block, shared.value, masks))
                if out:
                    rows = pa.array([o[0] for o in out])
                    keys = [batch.column(k).take(rows) for k in (0, 1)]
                    kinds = [pa.int64(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32())]
                    columns = [pa.array([o[k + 1] for o in out], kind) for k, kind in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays([*keys, *columns], names=REGION_COLUMNS)
                    del out, rows, keys, columns
            del batch, block
            give_back()
        give_back()

    return docs.mapInArrow(seek, REGION_SCHEMA)


REGION_SCHEMA = (
    "doc_id long, text_key long, region long, words array<long>, starts array<long>, ends array<long>, "
    "masks array<string>, hashes array<long>, places array<int>"
)
REGION_COLUMNS = [part.split()[0] for part in REGION_SCHEMA.split(", ")]


def _regions(block: list[tuple[int, int, bytes]], bits: np.ndarray, masks: list[str]) -> Iterator[tuple]:
    words, starts, ends = tokens(np.frombuffer(b"\n".join(piece for *_, piece in block), dtype=np.uint8))
    piece_starts = np.cumsum([0, *(len(piece) + 1 for *_, piece in block)])
    piece_of = np.searchsorted(piece_starts, starts, side="right") - 1
    found: list[tuple[int, str, int]] = []
    for mask in masks:
        hashes = window_hashes(words, mask)
        one, two = _filter_places(hashes)
        passed = np.flatnonzero(_passes(one, bits))
        passed = passed[_passes(two[passed], bits) & (piece_of[passed] == piece_of[passed + len(mask) - 1])]
        found.extend((at, mask, h) for at, h in zip(passed.tolist(), hashes[passed].view(np.int64).tolist()))
    found.sort()
    bounds = np.searchsorted(piece_of, np.arange(len(block) + 1))
    k = 0
    while k < len(found):
        piece = piece_of[found[k][0]]
        first, last = bounds[piece], bounds[piece + 1]
        low, high, n = max(first, found[k][0] - MARGIN), found[k][0] + SPAN + MARGIN, k + 1
        while n < len(found) and found[n][0] < last and found[n][0] - MARGIN < high:
            high, n = found[n][0] + SPAN + MARGIN, n + 1
        high = min(high, last)
        own, k = found[k:n], n
        row, offset, _ = block[piece]
        shift = offset - piece_starts[piece]
        yield (
            row, int(starts[low] + shift), words[low:high].view(np.int64), starts[low:high] + shift, ends[low:high] + shift,
            [m for _, m, _ in own], [h for _, _, h in own], [at - low for at, _, _ in own],
        )


def best_overlap(region: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(agreeing tokens, first, end in the region) of the longest stretch that counts as overlap; the
    item's token k lies beside the region's token k + shift. (0, 0, 0) if there is none."""
    low, high = max(0, shift), min(len(region), len(item) + shift)
    needed = min(MIN_OVERLAP, len(item))
    if high - low < needed:
        return 0, 0, 0
    same = region[low:high] == item[low - shift : high - shift]
    sums = np.append(0, np.cumsum(same))
    within = sums[needed:] - sums[:-needed]
    good = np.flatnonzero(within >= MIN_AGREEMENT * needed)
    if not len(good):
        return 0, 0, 0
    first, end = int(good[0]), int(good[-1]) + needed
    agreeing = np.flatnonzero(same[first:end])
    first, end = first + int(agreeing[0]), first + int(agreeing[-1]) + 1
    return int(same[first:end].sum()), low + first, low + end


def _verify(candidates: DataFrame) -> DataFrame:
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            out: list[tuple] = []
            for i in range(batch.num_rows):
                region = get["words"][i].values.to_numpy(zero_copy_only=False)
                item = get["item_words"][i].values.to_numpy(zero_copy_only=False)
                agreeing, first, end = best_overlap(region, item, get["shift"][i].as_py())
                if agreeing:
                    start_byte, end_byte = get["starts"][i][first].as_py(), get["ends"][i][end - 1].as_py()
                    out.append((i, agreeing, end - first, start_byte, end_byte))
            rows = pa.array([o[0] for o in out], pa.int64())
            kept = [get[n].take(rows) for n in ("doc_id", "text_key", "item_id", "item_copies", "item_tokens")]
            added = [pa.array([o[k] for o in out], pa.int64()) for k in range(1, 5)]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=OVERLAP_COLUMNS)

    return candidates.mapInArrow(check, OVERLAP_SCHEMA)


OVERLAP_SCHEMA = (
    "doc_id long, text_key long, item_id long, item_copies long, item_tokens int, agreeing long, overlap long, start_byte long, end_byte long"
)
OVERLAP_COLUMNS = [part.split()[0] for part in OVERLAP_SCHEMA.split(", ")]


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    shortest_item: int = SHORTEST_ITEM,
) -> DataFrame:
    """One row per document and item that overlap: doc_id, text_key (a hash that tells apart rows of
    one id), item_id, item_copies, item_tokens, agreeing and overlap (tokens of the longest overlap),
    start_byte and end_byte (its place in the document's UTF-8 text). Items of fewer than
    ``shortest_item`` tokens are not looked for."""
    items = durable(_items(benchmark, item_id_column, item_text_column, shortest_item), "benchmark-items")
    windows = durable(_item_windows(items), "benchmark-windows")
    # Lengths below MIN_OVERLAP are at most a handful of numbers.
    short = [r.n for r in items.select(F.size("words").alias("n")).where(F.col("n") < MIN_OVERLAP).distinct().collect()]
    keyed = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_key(F.col(text_column)).alias("text_key"), text_column)
    regions = durable(_seeded_regions(keyed, _filter_bits(windows), sorted(short)).distinct(), "seeded-regions")
    seeds = regions.select(
        "doc_id", "text_key", "region", F.explode(F.arrays_zip("masks", "hashes", "places")).alias("seed")
    ).select("doc_id", "text_key", "region", F.col("seed.masks").alias("mask"), F.col("seed.hashes").alias("hash"), F.col("seed.places").alias("at"))
    # Of matches of a whole item without substitutions, the first of a region tells all.
    shift = F.col("at") - F.col("item_at")
    apart = F.when(F.col("mask").contains("0"), shift).alias("apart")
    hits = (
        seeds.join(windows, ["mask", "hash"])
        .groupBy("doc_id", "text_key", "region", "item_key", apart)
        .agg(F.min(shift).alias("shift"))
        .drop("apart")
    )
    sides = items.select("item_key", "item_id", "item_copies", F.col("words").alias("item_words"), F.size("words").alias("item_tokens"))
    place = ["text_key", "region"]
    regions = regions.drop("masks", "hashes", "places")
    same_doc = regions["doc_id"].eqNullSafe(hits["doc_id"])
    candidates = (
        hits.join(regions, [*(hits[c] == regions[c] for c in place), same_doc])
        .select(hits["doc_id"], hits["text_key"], "words", "starts", "ends", "item_key", "shift")
        .join(sides, "item_key")
    )
    longest = F.max_by(
        F.struct("agreeing", "overlap", "start_byte", "end_byte", "item_copies", "item_tokens"),
        F.struct("agreeing", "overlap", -F.col("start_byte")),
    )
    found = _verify(candidates).groupBy("doc_id", "text_key", "item_id").agg(longest.alias("best"))
    return found.select("doc_id", "text_key", "item_id", "best.*")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, shortest_item: int = SHORTEST_ITEM) -> DataFrame:
    """The documents (doc_id, text and any other columns) that overlap no benchmark item of at least
    ``shortest_item`` tokens."""
    found = overlaps(docs, benchmark, shortest_item=shortest_item).select("doc_id", "text_key").distinct()
    gone = durable(found.withColumnsRenamed({"doc_id": "gone_id", "text_key": "gone_key"}), "contaminated")
    return without_rows(docs, gone)
