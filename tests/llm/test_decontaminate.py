"""Planted benchmark passages, with substitutions, against a comparison of all places."""

import itertools
import random

import numpy as np
import pytest

from ledgerlane.llm import decontaminate
from ledgerlane.llm.decontaminate import MASKS, MIN_AGREEMENT, MIN_OVERLAP, best_overlap, overlaps, tokens, without_contaminated

WORDS = [f"w{i}" for i in range(3000)]


def prose(rng, n):
    return rng.choices(WORDS, k=n)


def plain_overlap(doc, item):
    """Whether any alignment has enough neighbouring tokens that agree."""
    needed = min(MIN_OVERLAP, len(item))
    for shift in range(-len(item), len(doc)):
        same = [0 <= k + shift < len(doc) and doc[k + shift] == w for k, w in enumerate(item)]
        if any(sum(same[i : i + needed]) >= MIN_AGREEMENT * needed for i in range(len(item) - needed + 1)):
            return True
    return False


def hashed(text):
    return tokens(np.frombuffer(text.encode(), dtype=np.uint8))


def test_tokens():
    text = "Ab, ab--AB é1  " + "x" * 200 + "."
    words, starts, ends = hashed(text)
    data = text.encode()
    assert [data[s:e].decode() for s, e in zip(starts, ends)] == ["Ab", "ab", "AB", "é1", "x" * 200]
    assert words[0] == words[1] == words[2] and len(set(words.tolist())) == 3
    folded, *_ = hashed("École\u00a0école “école”—ÉCOLE × Þ þ")
    assert len(set(folded[:4].tolist())) == 1 and len(folded) == 7 and folded[5] == folded[6]
    assert len(hashed(" .,")[0]) == len(hashed("")[0]) == 0
    assert len({hashed("x" * n)[0][0] for n in range(1, 300)}) == 299


def test_every_two_substitutions_leave_a_hit():
    places = [{k + at for k, c in enumerate(mask) if c == "1"} for mask in MASKS for at in range(MIN_OVERLAP - len(mask) + 1)]
    for a in range(MIN_OVERLAP):
        for b in range(a):
            assert any(not p & {a, b} for p in places)


def test_every_three_substitutions_leave_a_hit():
    places = [{k + at for k, c in enumerate(mask) if c == "1"} for mask in MASKS for at in range(MIN_OVERLAP - len(mask) + 1)]
    assert all(any(not p & {*changed} for p in places) for changed in itertools.combinations(range(MIN_OVERLAP), 3))


def test_planted_passages_with_three_substitutions(spark):
    rng = random.Random(5)
    items = [prose(rng, n) for n in (15, 16, 17, 18, 30)]
    docs, want = [], set()
    for d, changed in enumerate(itertools.combinations(range(15), 3)):
        passage = [w if k not in changed else "zz" for k, w in enumerate(items[d % 5])]
        words = prose(rng, 20) + passage + prose(rng, 20)
        docs.append((d, " ".join(words)))
        want |= {(d, i) for i, item in enumerate(items) if plain_overlap(words, item)}
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = overlaps(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(want) == len(docs)


def test_short_items(spark):
    rng = random.Random(6)
    items = [prose(rng, n) for n in range(1, 15)]
    docs, want = [], set()
    for n, item in enumerate(items, start=1):
        accepted = max(c for c in range(n) if n - c >= MIN_AGREEMENT * n)
        for changed in itertools.combinations(range(n), accepted):
            passage = ["zz" if k in changed else w for k, w in enumerate(item)]
            words = prose(rng, 15) + passage + prose(rng, 15) + passage + prose(rng, 15)
            want |= {(len(docs), i) for i, other in enumerate(items) if plain_overlap(words, other)}
            docs.append((len(docs), " ".join(words)))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in overlaps(table, benchmark, shortest_item=1).collect()}
    assert got == want and len(want) >= len(docs)
    by_default = {(r.doc_id, r.item_id) for r in overlaps(table, benchmark).collect()}
    assert by_default == {(d, i) for d, i in got if len(items[i]) >= 5}


@pytest.mark.parametrize("block", [1 << 22, 600])
def test_planted_passages(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(3)
    items = [prose(rng, n) for n in (15, 20, 40, 60, 11, 12, 8, 5, 4)]
    docs, want = [], set()
    for d in range(240):
        words = prose(rng, rng.randint(0, 400))
        if d % 2:
            item = d // 2 % len(items)
            passage = list(items[item])
            for k in rng.sample(range(len(passage)), rng.choice([0, 0, 1, 2])):
                passage[k] = "zz"
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((d, " ".join(words).upper() if d % 3 else "\n".join(words), "x"))
        want |= {(d, i) for i, item in enumerate(items) if len(item) >= 5 and plain_overlap(words, item)}
    benchmark = [(i, " ".join(w)) for i, w in enumerate(items)] + [(100, " ".join(items[0])), (101, None), (None, "")]
    found = overlaps(
        spark.createDataFrame(docs, "doc_id long, text string, item_id string"),
        spark.createDataFrame(benchmark, "item_id long, text string"),
    ).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    # Nothing else is found; short items match whole only where no more than the masks allow is changed.
    assert got <= want
    sure = {(d, i) for d, i in want if len(items[i]) >= MIN_OVERLAP}
    assert sure <= got
    assert {r.item_copies for r in found if r.item_id == 0} == {2}
    for r in found:
        data = docs[r.doc_id][1].encode()[r.start_byte : r.end_byte].decode().lower().split()
        assert len(data) == r.overlap and r.agreeing >= 0.8 * r.overlap - 3


def test_best_overlap():
    item = np.arange(1, 31)
    region = np.concatenate([[0, 0], item, [0]])
    assert best_overlap(region, item, 2) == (30, 2, 32)
    region[10] = 99
    assert best_overlap(region, item, 2) == (29, 2, 32)
    assert best_overlap(region, item, 3) == (0, 0, 0)


def test_only_contaminated_documents_go(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    benchmark = spark.read.parquet(f"{data}/benchmark.parquet")
    items = [hashed(r.text)[0].tolist() for r in benchmark.collect()]
    want = set()
    for r in docs.select("doc_id", "text").collect():
        words = hashed(r.text)[0].tolist()
        places = {}
        for k, w in enumerate(words):
            places.setdefault(w, []).append(k)
        # Alignments that share at least one token of the item's first half with the document.
        for item in items:
            needed = min(MIN_OVERLAP, len(item))
            shifts = {p - k for k, w in enumerate(item) for p in places.get(w, ())}
            for shift in shifts:
                same = [0 <= k + shift < len(words) and words[k + shift] == w for k, w in enumerate(item)]
                if sum(same) >= MIN_AGREEMENT * needed and any(
                    sum(same[i : i + needed]) >= MIN_AGREEMENT * needed for i in range(len(item) - needed + 1)
                ):
                    want.add(r.doc_id)
                    break
    kept = without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == want
    assert want


def test_nulls_repeats_and_empty_tables(spark):
    item = " ".join(f"t{i}" for i in range(20))
    docs = spark.createDataFrame(
        [(None, item, 1), (1, item, 1), (1, item, 1), (1, "other words", 1), (2, None, 1), (3, "", 1), (4, (item + " and more ") * 500, 1)],
        "doc_id long, text string, bad_id int",
    )
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = sorted((str(r.doc_id), r.text) for r in without_contaminated(docs, benchmark).select("doc_id", "text").collect())
    assert kept == [("1", "other words"), ("2", None), ("3", "")]
    assert {r.doc_id for r in overlaps(docs, benchmark).collect()} == {None, 1, 4}
    assert overlaps(docs, benchmark.limit(0)).count() == 0
    assert without_contaminated(docs, benchmark.limit(0)).count() == 7
    assert without_contaminated(docs.limit(0), benchmark).count() == 0
