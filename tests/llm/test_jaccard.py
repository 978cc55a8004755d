"""The join against brute force, its bound against exact overlaps, and its bands by enumeration."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from ledgerlane.llm import jaccard
from ledgerlane.llm.queries import QUERIES


def documents(spark, rows):
    return spark.createDataFrame([(*row, 1, b"x", 2) for row in rows], "doc_id long, text string, n int, set_key binary, row int")


def shingle_set(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return set(zip(words, words[1:], words[2:])) if len(words) > 2 else {tuple(words)} if words else set()


def linked(a, b, percent=90):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def brute_force(rows, percent=90):
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    holders = defaultdict(list)
    for k, own in enumerate(sets):
        for j in {j for s in own for j in holders[s]}:
            if linked(own, sets[j], percent):
                root[find(k)] = find(j)
        for s in own:
            holders[s].append(k)
    smallest = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        smallest[find(k)].append(doc_id)
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in smallest.items()}
    return sorted(((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op13_jaccard_join"](spark, folder)) == brute_force(rows)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.randint(0, 1)] = [f"x{rng.random()}"] * rng.randint(0, 1)
    return words


def near_copies(seed, groups, copies):
    """Copies about the threshold, in chains too, of texts from nine words on."""
    rng, texts = random.Random(seed), []
    for g in range(groups):
        words = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([9, 12, 20, 40, 90, 300]))]
        for _ in range(copies):
            texts.append(" ".join(edited(rng, words, rng.randint(0, max(1, len(words) // 45)))))
            if rng.random() < 0.3:
                words = edited(rng, words, 1)
    return texts


@pytest.mark.parametrize(("seed", "block"), [(1, 1024), (2, 5)])
def test_copies_about_the_threshold(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    rows = list(enumerate(near_copies(seed, 24, 25)))
    random.Random(seed).shuffle(rows)
    want = brute_force(rows)
    assert 24 < len({c for *_, c in want}) < len(rows) - 100
    assert found(jaccard.similar_components(documents(spark, rows))) == want


def test_all_links_between_classes(spark):
    rows = list(enumerate(near_copies(2, 12, 25)))
    links, members = jaccard.similar_pairs(documents(spark, rows))
    class_of = {r.doc_id: r.class_id for r in members.collect()}
    sets = [shingle_set(text) for _, text in rows]
    want = {
        tuple(sorted((class_of[i], class_of[j])))
        for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and class_of[i] != class_of[j] and linked(a, b)
    }
    assert len(want) > 100
    assert sorted((r.a, r.b) for r in links.collect()) == sorted(want)
    assert all((class_of[i] == class_of[j]) == (sets[i] == sets[j]) for i in range(40) for j in range(40))


def test_bands_reach_every_partner_and_parts_cover_every_difference():
    for percent in (80, 90, 95):
        tops = jaccard._band_tops(1 << 12, percent)
        band = {n: next(k for k, top in enumerate(tops) if n <= top) for n in range(1, 4000)}
        for a in range(1, 3000):
            reach = [b for b in range(a, min(4000, 100 * a // percent + 2)) if 100 * a >= percent * b]
            assert {band[b] - band[a] for b in reach} <= {0, 1}
            parts = jaccard._most_differing(tops[band[a]] + 100 * tops[band[a]] // percent, percent) + 1
            for b in (reach[0], reach[-1]):
                least = jaccard._least_overlap(a + b, percent)
                assert 100 * least >= percent * (a + b - least) and 100 * (least - 1) < percent * (a + b - least + 1)
                assert a + b - 2 * least < parts


def test_the_bound_never_loses_a_link():
    rng = np.random.default_rng(3)
    for _ in range(300):
        base = np.unique(rng.integers(0, 1 << 63, rng.integers(2, 600), dtype=np.uint64))
        drop = rng.integers(0, 1 + len(base) // 12)
        other = np.unique(np.concatenate([base[drop:], rng.integers(0, 1 << 63, rng.integers(0, 1 + len(base) // 12), dtype=np.uint64)]))
        if jaccard._links(base, other, 90):
            x, y = jaccard._bitmap(base), jaccard._bitmap(other)
            words = min(len(x), len(y))
            x, y = jaccard._folded(x, words), jaccard._folded(y, words)
            assert jaccard._may_link(len(base), x, np.array([len(other)]), y[None], 90)[0]


def test_blocks_of_a_text_give_the_same_set(monkeypatch):
    text = " ".join(f"w{k % 700}" for k in range(5000))
    whole = jaccard.shingle_hashes(text)
    monkeypatch.setitem(jaccard.word_blocks.__globals__, "BLOCK_BYTES", 1)
    assert (jaccard.shingle_hashes(text) == whole).all() and len(whole) == len(shingle_set(text))


def test_odd_rows(spark):
    long_text = " ".join(f"v{k}" for k in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one\ttwo "), (8, "one two three"),
        (None, "one"), (None, "alone here now"), (9, long_text), (10, long_text + " end"), (10, "one two"), (11, long_text.upper()),
    ]
    assert found(jaccard.similar_components(documents(spark, rows))) == brute_force(rows)


def test_empty_table(spark):
    assert jaccard.similar_components(documents(spark, [])).count() == 0
