"""Counts after edits equal counts of the edited text."""

import random

import pytest

from ledgerlane.llm.tokencount import (
    _CUT,
    PATTERN,
    TokenTree,
    apply_edits,
    count_tokens,
    counted_and_edited,
    cut,
    encoding,
    sample_edits,
)

TEXTS = ["", "a", "word " * 300, "日本語。テスト。" * 100, "   \n\n  x" * 200, "it's'll 're " * 100, "x" * 3000, "<|endoftext|> é 1'll\n\n"]


def tokens(text):
    return len(encoding().encode_ordinary(text))


def test_the_pattern_is_that_of_the_public_files():
    import public_tokenizers

    assert PATTERN == public_tokenizers.PATTERN


@pytest.mark.parametrize("text", TEXTS)
def test_leaves_have_the_tokens_of_the_text(text):
    leaves = cut(text)
    assert "".join(leaves) == text
    tree = TokenTree.of(text, encoding())
    assert (tree.n_tokens, tree.n_chars) == (tokens(text), len(text))


@pytest.mark.parametrize("text", TEXTS)
def test_random_edits(text):
    rng = random.Random(len(text))
    alphabet = " \n'lreabc.ñ日1"
    tree = TokenTree.of(text, encoding())
    for step in range(25):
        start = rng.randint(0, len(text) + 2)
        end = start + rng.choice([0, 0, 1, 3, 600])
        new = "".join(rng.choices(alphabet, k=rng.choice([0, 1, 2, 20, 3000])))
        tree.edit(start, end, new)
        text = text[:start] + new + text[end:]
        if step % 7 == 0:
            tree = TokenTree.kept(text, *tree.filled(), encoding())
        assert (tree.text(), tree.n_tokens, tree.n_chars) == (text, tokens(text), len(text))


def test_a_small_edit_encodes_a_small_part():
    text = "some words of a long text " * 4000
    tree = TokenTree.of(text, encoding())
    tree.edit(50_000, 50_003, "xyz")
    assert tree.n_tokens == tokens(text[:50_000] + "xyz" + text[50_003:])
    assert tree.chars_encoded < 1000


def test_every_cut_place_keeps_the_tokens():
    rng = random.Random(11)
    alphabet = ["a", "s", "re", "'", "'s", "1", "23", " ", "  ", "\n", "\t", "!", "é", "e\u0301", "日", "½", "\u00a0", "\u2028", "\x1c", "\u200b", "٣", "_"]
    for _ in range(400):
        text = "".join(rng.choices(alphabet, k=60))
        whole = encoding().encode_ordinary(text)
        for found in _CUT.finditer(text, overlapped=True):
            at = found.end()
            assert encoding().encode_ordinary(text[:at]) + encoding().encode_ordinary(text[at:]) == whole, (text, at)


@pytest.mark.parametrize("part", ["12 4 88 ", "7", "日本語", "1,2;", "a1"])
def test_texts_without_words_have_leaves_too(part):
    rng = random.Random(3)
    text = (part * 200_000)[:200_000]
    if part == "7":
        text = "".join(rng.choice("0123456789") + (" " if k % 9 == 0 else "") for k in range(180_000))
    tree = TokenTree.of(text, encoding())
    tree.edit(100_000, 100_001, "x")
    assert tree.n_tokens == tokens(text[:100_000] + "x" + text[100_001:])
    if part != "日本語":  # one run of letters is one pre-token
        assert tree.chars_encoded < 0.02 * len(text)


def test_query_against_whole_encoding(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: r for r in counted_and_edited(docs).collect()}
    assert len(got) == docs.count()
    for row in docs.select("doc_id", "text", sample_edits("text", "doc_id").alias("edits")).collect():
        text = row.text
        assert got[row.doc_id].n_tokens == tokens(text)
        for e in row.edits:
            text = text[: e.start] + e.replacement + text[e.end :]
        assert (got[row.doc_id].n_tokens_edited, got[row.doc_id].n_chars_edited) == (tokens(text), len(text))


def test_nulls_repeats_and_clashing_columns(spark):
    kind = "array<struct<start:int,end:int,replacement:string>>"
    docs = spark.createDataFrame(
        [(1, None, 5, [(0, 1, "x")]), (2, "", 6, [(0, 0, "new text")]), (2, "abc", 7, None), (2, "abc", 7, [(1, None, "q"), (9, 9, None), (2, 0, "!")])],
        f"doc_id long, text string, N_TOKENS int, edits {kind}",
    )
    counted = count_tokens(docs)
    assert [c.lower() for c in counted.columns] == ["doc_id", "text", "edits", "n_tokens", "leaf_chars", "leaf_tokens"]
    rows = [(r.text, r.n_tokens) for r in apply_edits(counted).collect()]
    assert rows == [(None, None), ("new text", tokens("new text")), ("abc", tokens("abc")), ("ab!c", tokens("ab!c"))]
    assert apply_edits(count_tokens(docs.limit(0))).count() == 0
