"""SimHash near-duplicates, found by multi-index hashing.

A fingerprint is cut into two halves of 32 bits. Two fingerprints that differ in at most three
bits differ in at most one bit in one of the halves, so probing each half's table with every key
of a Hamming ball of radius one finds all of them; full distances are then verified. A table entry
with many members is dealt out by the other half's four quarters: of these, two fingerprints within
three bits have at least one in common.

Texts that are null or hold no word get fingerprint zero and are linked like any other. Rows with
a repeated or null doc_id keep their own row; a component without any doc_id has a null id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.durable import drop_durable, durable
from ledgerlane.llm.components import connected_components
from ledgerlane.llm.memory import mapped
from ledgerlane.llm.tables import text_key, without_rows

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
HASH_SEED = 42
HALF_BITS = 32
QUARTER_BITS = 8
#: Members from which on an entry of a half's table is dealt out by quarters of the other half.
HOT_MEMBERS = 1 << 10
BLOCK_BYTES = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in blocks cut at white space, so that a long text is never split whole."""
    start = 0
    while start < len(data):
        cut = _SPACE.search(data, start + BLOCK_BYTES)
        end = cut.start() if cut else len(data)
        yield data[start:end].split()
        start = end


def _set_bits(shingles: list[bytes]) -> np.ndarray:
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), dtype="<u8", count=len(shingles)
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash: a bit is set where over half of the shingle hashes set it."""
    counts, total = np.zeros(64, dtype=np.int64), 0
    carried: list[bytes] = []
    for block in _word_blocks((text or "").encode("utf-8", "surrogatepass").translate(_LOWER)):
        words = carried + block
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(shingle_words)))))
        if shingles:
            counts += _set_bits(shingles)
            total += len(shingles)
        carried = words[-(shingle_words - 1) :] if shingle_words > 1 else []
    if not total and carried:
        counts, total = _set_bits([b" ".join(carried)]), 1
    return sum(1 << k for k in np.flatnonzero(2 * counts > total).tolist())


def fingerprint_column(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long with the same bits."""

    @F.pandas_udf("long")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return mapped(prints_of, batches)

    def prints_of(texts: pd.Series) -> pd.Series:
        prints = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
        return pd.Series(prints.view(np.int64))

    return signed(text)


def _other_half(bits: Column, key: Column) -> Column:
    """The half that a key does not hold."""
    return F.when(F.shiftrightunsigned(key, HALF_BITS) == 0, bits.bitwiseAND((1 << HALF_BITS) - 1)).otherwise(
        F.shiftrightunsigned(bits, HALF_BITS)
    )


def _dealt(rows: DataFrame, hot: DataFrame, bits: str) -> DataFrame:
    """Rows of hot keys once for each quarter of the other half of ``bits``, the others as they are. ``part`` is the
    quarter's number and value, or -1."""
    other = _other_half(F.col(bits), F.col("key"))
    parts = [
        F.shiftright(other, k * QUARTER_BITS).bitwiseAND((1 << QUARTER_BITS) - 1).bitwiseOR(k << QUARTER_BITS).cast("int")
        for k in range(HALF_BITS // QUARTER_BITS)
    ]
    whole = F.array(F.lit(-1))
    marked = rows.join(hot.withColumn("hot", F.lit(True)), "key", "left")
    return marked.select(bits, "key", F.explode(F.when(F.col("hot"), F.array(*parts)).otherwise(whole)).alias("part"))


def near_links(prints: DataFrame, hot_members: int = HOT_MEMBERS) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct longs of column ``fingerprint`` within the distance, written."""
    # A key is a half with the number of its segment above it.
    keys = [
        F.shiftrightunsigned("fingerprint", HALF_BITS),
        F.col("fingerprint").bitwiseAND((1 << HALF_BITS) - 1).bitwiseOR(1 << HALF_BITS),
    ]
    ball = F.array(F.lit(0).cast("long"), *(F.lit(1 << k).cast("long") for k in range(HALF_BITS)))
    entries = prints.select(F.col("fingerprint").alias("b"), F.explode(F.array(*keys)).alias("key"))
    probes = prints.select(F.col("fingerprint").alias("a"), F.explode(F.array(*keys)).alias("own")).select(
        "a", F.explode(F.transform(ball, lambda bit: F.col("own").bitwiseXOR(bit))).alias("key")
    )
    hot = durable(
        entries.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot_members).select("key"), "simhash-hot-keys"
    )
    differing = F.col("a").bitwiseXOR(F.col("b"))
    # A pair that is close in both halves counts in the upper half only.
    first = (F.shiftrightunsigned("key", HALF_BITS) == 0) | (F.bit_count(F.shiftrightunsigned(differing, HALF_BITS)) > 1)
    # So does one that shares several quarters: in the lowest of them.
    quarter = F.shiftright("part", QUARTER_BITS)
    unlike = [
        F.shiftright(_other_half(differing, F.col("key")), k * QUARTER_BITS).bitwiseAND((1 << QUARTER_BITS) - 1) != 0
        for k in range(HALF_BITS // QUARTER_BITS)
    ]
    lowest = reduce(lambda x, y: x & y, [(quarter <= k) | unlike[k] for k in range(len(unlike))])
    links = durable(
        _dealt(probes, hot, "a")
        .join(_dealt(entries, hot, "b"), ["key", "part"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(differing) <= MAX_DISTANCE) & first & lowest)
        .select("a", "b"),
        "simhash-links",
    )
    drop_durable(hot)
    return links


def _classed(docs: DataFrame, id_column: str, text_column: str, shingle_words: int) -> tuple[DataFrame, DataFrame]:
    """The rows (id, text_key, fingerprint) and the classes (fingerprint, component, component_id, copies), written."""
    rows = durable(
        docs.select(
            F.col(id_column).alias("id"),
            text_key(F.col(text_column)).alias("text_key"),
            fingerprint_column(F.col(text_column), shingle_words).alias("fingerprint"),
        ),
        "simhash-rows",
    )
    prints = durable(
        rows.groupBy("fingerprint").agg(F.min("id").alias("first_id"), F.count("*").alias("copies")), "simhash-prints"
    )
    links = near_links(prints)
    labels = connected_components(links)
    drop_durable(links)
    linked = labels.withColumnRenamed("node", "fingerprint")
    known = prints.join(linked, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    smallest = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = durable(
        known.join(smallest, "component").select("fingerprint", "component", "component_id", "copies"), "simhash-classes"
    )
    drop_durable(prints)
    return rows, classes


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (hex), component_id (smallest id reachable) and copies
    (rows with this fingerprint)."""
    rows, classes = _classed(docs, id_column, text_column, shingle_words)
    return rows.join(classes, "fingerprint").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
        "copies",
    )


def without_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row of ``docs`` per component: that of its smallest id, and of the smallest text hash among rows
    of one id. Of rows equal in both, any one stays."""
    rows, classes = _classed(docs, id_column, text_column, shingle_words)
    place = F.struct(F.col("id").isNull(), "id", "text_key")
    members = rows.join(classes.select("fingerprint", "component"), "fingerprint")
    kept = members.groupBy("component").agg(F.min(place).alias("kept")).select("kept.id", "kept.text_key")
    same = ["id", "text_key"]
    counts = rows.groupBy(*same).agg(F.count("*").alias("n"))
    # Rows that go are fewer than those that stay, so they are the side to look up.
    gone = durable(counts.join(kept.withColumn("stays", F.lit(True)), _null_safe(counts, kept, same), "left").select(
        counts["id"].alias("gone_id"), counts["text_key"].alias("gone_key"), F.col("stays").isNull().alias("gone"), "n"
    ).where(F.col("gone") | (F.col("n") > 1)), "simhash-gone")
    drop_durable(rows, classes)
    repeated = gone.where("not gone")
    found = (text_key(docs[text_column]) == repeated["gone_key"]) & docs[id_column].eqNullSafe(repeated["gone_id"])
    again = docs.join(repeated, found, "left_semi")
    return without_rows(docs, gone, id_column, text_column).union(again.dropDuplicates([id_column, text_column]))


def _null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [left[c].eqNullSafe(right[c]) for c in columns])
