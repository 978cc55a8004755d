"""Fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from ledgerlane.llm.components import connected_components
from ledgerlane.llm.simhash import fingerprint, near_duplicates, near_links, without_near_duplicates


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(prints):
    """fingerprint -> smallest fingerprint reachable."""
    prints, root = sorted(set(prints)), {}
    for p in prints:
        if p in root:
            continue
        root[p], open_ends = p, [p]
        while open_ends:
            at = open_ends.pop()
            for q in prints:
                if q not in root and (at ^ q).bit_count() <= 3:
                    root[q] = p
                    open_ends.append(q)
    return root


@pytest.mark.parametrize("text", [None, "", "  \t", "One", "a B", "A b c", "ÀB c d e\x0bf g", "x y z " * 50])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_long_texts_are_read_in_blocks(monkeypatch):
    from ledgerlane.llm import simhash

    text = " ".join(f"word{i % 97}" for i in range(5000)) + " tail"
    want = plain_fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 100)
    assert fingerprint(text) == want


@pytest.mark.parametrize("hot_members", [0, 2, 1 << 10])
def test_links_of_planted_distances(spark, hot_members):
    base = [0, -1, 0x0123456789ABCDEF, -(1 << 63)]
    masks = [0, 1, 1 << 63, 1 << 31 | 1, 7, 7 << 31, 1 | 1 << 32 | 1 << 63, 15, 1 << 40 | 3]
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    values = sorted({signed((b ^ m) & ((1 << 64) - 1)) for b in base for m in masks})
    df = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    want = {(a, b) for a in values for b in values if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    got = [(r.a, r.b) for r in near_links(df, hot_members).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_links_of_a_half_that_many_share(spark):
    rng = random.Random(3)
    values = {0x77 << 32 | rng.getrandbits(32) for _ in range(1500)} | {rng.getrandbits(31) << 32 | 0x55 for _ in range(1500)}
    for v in sorted(values)[::10]:
        values.add(v ^ sum(1 << b for b in rng.sample(range(63), rng.randint(1, 4))))
    df = spark.createDataFrame([(v,) for v in sorted(values)], "fingerprint long")
    bits = np.array(sorted(values), dtype=np.uint64)
    want = {(int(a), int(b)) for a in bits for b in bits[(np.bitwise_count(bits ^ a) <= 3) & (bits > a)]}
    got = [(r.a, r.b) for r in near_links(df).collect()]
    assert len(want) > 200 and len(got) == len(set(got)) and set(got) == want


def test_components_of_a_long_chain_a_star_and_repeats(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 4), (300, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 300: 200}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    root = classes(prints.values())
    smallest = {}
    for d, p in prints.items():
        smallest[root[p]] = min(d, smallest.get(root[p], d))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == {d: (f"{p:016x}", smallest[root[p]]) for d, p in prints.items()}
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(smallest.values())


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    schema = "doc_id long, text string, id int, fingerprint string, gone boolean, _text_key int"
    rows = [(5, None, 1, "f", True, 0), (4, "", 1, "f", True, 0), (None, "a b c d", 1, "f", True, 0),
            (None, "a b c d", 1, "f", True, 0), (9, "e f g h", 2, "f", True, 0), (9, "e f g h", 2, "f", True, 0),
            (9, "entirely other words here", 3, "f", True, 0)]
    docs = spark.createDataFrame(rows, schema)
    got = [(r.doc_id, r.fingerprint == "0" * 16, r.component_id) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [(5, True, 4), (4, True, 4), (None, False, None), (None, False, None), (9, False, 9), (9, False, 9), (9, False, 9)],
        key=str,
    )
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [
        ("4", ""), ("9", "e f g h"), ("9", "entirely other words here"), ("None", "a b c d")
    ]
    assert near_duplicates(docs.limit(0)).count() == 0
    assert without_near_duplicates(docs.limit(0)).count() == 0
