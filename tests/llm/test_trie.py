"""The trie against SQL and against a brute-force version, with hot, deep and odd conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import connect, differences

from ledgerlane.llm import trie
from ledgerlane.llm.queries import QUERIES


def conversations(spark, rows):
    return spark.createDataFrame([(*row, 1, "x") for row in rows], "conv_id long, turn long, role string, text string, depth int, path string")


def brute_force(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv_id].append((turn is not None, turn or 0, role, key, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(c - 5 * int(c / 5))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(members[path]) - 1) * size + sum(saved[c] for c in children[path])
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def found(df):
    return sorted(tuple(r[c] for c in trie.NODE_COLUMNS[:-1]) for r in df.collect())


def test_query_equals_the_statement(spark, data):
    assert differences(QUERIES["op12_conversation_trie"](spark, data), connect(data), trie.ORACLE_SQL) == []


def shared_conversations(seed, n):
    """Many equal conversations, a common first turn, short alphabets, negative ids, some deep."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-n, 2 * n), n):
        kind = rng.random()
        length = 40 if kind < 0.02 else rng.randint(1, 6)
        for t in range(length):
            text = "same" if kind < 0.4 else f"first{t}" if t < 2 and kind < 0.7 else rng.choice(["a", "é" * 3, "", None])
            rows.append((c, t, rng.choice(["user", "assistant"]) if kind > 0.9 else ("user", "assistant")[t % 2], text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards", [1, 7, 60])
def test_any_number_of_shards(spark, monkeypatch, shards):
    rows = shared_conversations(shards, 400)
    monkeypatch.setattr(trie, "SHARD_BYTES", max(1, 400 * 80 // shards))
    monkeypatch.setattr(trie, "SPLITTER_TURNS", 3)
    monkeypatch.setitem(trie._walked.__globals__, "BLOCK_IDS", 11)
    assert found(trie.conversation_trie(conversations(spark, rows))) == brute_force(rows)


def test_skeleton_numbers_children_after_parents():
    a, b, c = (bytes([k]) * trie.DIGEST_BYTES for k in range(3))
    skeleton = trie.Skeleton([(a, 1), (a + b, 2), (a + b, 9), (c, 4)])
    assert skeleton.parent == [-1, 0, 1, 0]
    assert skeleton.child == {(0, a): 1, (1, b): 2, (0, c): 3}


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "left out"), (3, None, None, None), (3, None, "user", "b"), (3, None, "user", "a"), (3, 0, "user", "x"),
        (3, 0, "user", "x"), (7, 5, "user", "t" * 200_000), (8, 0, "", ""), (-7, 1, "user", "y"), (0, 0, "user", "z"), (1, 0, "user", "z"),
    ]
    assert found(trie.conversation_trie(conversations(spark, rows))) == brute_force(rows)


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    c = next(c for c in range(6, 10_000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(c, 0, "user", "q"), (c, 1, "assistant", "a")]
    assert found(trie.conversation_trie(conversations(spark, rows))) == brute_force(rows)
    assert len(brute_force(rows)) == 1


def test_empty_table(spark):
    assert trie.conversation_trie(conversations(spark, [])).count() == 0
    assert trie.conversation_trie(conversations(spark, [(None, 0, "user", "x")])).count() == 0
