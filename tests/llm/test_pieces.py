"""Pieces against the library, against the heap, and back to the text."""

import random
import re

import numpy as np
import pytest
import sentencepiece

from ledgerlane.llm.pieces import (
    _CHUNK,
    _LETTERS,
    _MARKS,
    MODEL_PATH,
    Encoder,
    _split,
    _with_bytes,
    decode,
    decode_documents,
    encode_chunk,
    encode_chunks,
    encode_documents,
    load,
)

ODD = ["", "  a", " ", "a\n\n b", "a\tb", "日本語 テスト", "😀😀 x", "x" * 500 + " y", "ab" * 40, "  " * 30, "thethethe " * 20, "a.b,c!! d² e².", "é e\u0301"]


@pytest.fixture(scope="module")
def texts(spark, data):
    return [r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()] + ODD


def test_without_dropout_the_pieces_are_the_library_s(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    got = Encoder(load(), dropout=0).encode(texts, range(len(texts)))
    assert all(library.encode(t) == g.tolist() for t, g in zip(texts, got))


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_round_trip(texts, dropout):
    odd = [*texts, "▁", "▁x ▁▁ y", " ▁"]
    got = Encoder(load(), dropout=dropout).encode(odd, range(len(odd)))
    assert [decode(g.tolist(), load()) for g in got] == odd


def test_side_by_side_equals_the_heap(texts):
    chunks = sorted({c for t in texts for c in _split(t) if len(c) <= 32})[:3000]
    rng = random.Random(2)
    keys = [rng.getrandbits(64) for _ in chunks]
    for dropout in (0.0, 0.3):
        side = encode_chunks(chunks, keys, dropout, load())
        for i, (chunk, key) in enumerate(zip(chunks, keys)):
            assert side.take(np.array([i])).tolist() == _with_bytes(encode_chunk(chunk, key, dropout, load()), load())


def test_dropout_varies_by_seed_and_place_and_repeats():
    text = "unbelievable representations " * 6
    encode = lambda seed, key: Encoder(load(), 0.3, seed).encode([text], [key])[0].tolist()
    assert encode(1, 5) == encode(1, 5)
    assert len({tuple(encode(seed, 5)) for seed in range(8)}) > 4
    one = Encoder(load(), 0.3, 1).encode([text], [5])[0]
    words = np.split(one, np.flatnonzero([load().texts[i].startswith(b" ") for i in one]))
    assert len({tuple(w) for w in words if len(w)}) > 2
    assert len(encode(1, 5)) > len(Encoder(load(), 0).encode([text], [5])[0])


def test_documents_nulls_repeats_and_clashing_columns(spark, texts):
    rows = [(1, "some text", 9), (None, None, 9), (1, "some text", 9), (3, "", 9), (4, "▁", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_PIECES int")
    got = encode_documents(docs)
    assert [c.lower() for c in got.columns] == ["doc_id", "text", "piece_ids", "n_pieces", "lossless"]
    found = got.collect()
    assert [(r.n_pieces is None, r.lossless) for r in found] == [(False, True), (True, None), (False, True), (False, True), (False, True)]
    assert found[0].piece_ids == found[2].piece_ids and found[3].piece_ids == []
    assert [r.text for r in decode_documents(got).collect()] == [r[1] for r in rows]
    assert encode_documents(docs.limit(0)).count() == 0


def test_every_occurrence_draws_its_own_merges():
    line = "unbelievable representations of internationalization"
    got = Encoder(load()).encode([line] * 300, range(300))
    assert len({tuple(g) for g in got}) > 30
    words = [tuple(Encoder(load()).encode([" ".join(["representations"] * 300)], [key])[0]) for key in (1, 2)]
    assert words[0] != words[1]
    # An occurrence has the pieces that it has when it is merged alone, remembered paths or not.
    texts = [line, "the cat " * 40, "x" * 50, "日本 the"] * 30
    for dropout in (0.0, 0.1, 0.5, 1.0):
        encoder = Encoder(load(), dropout)
        for _ in range(2):
            got = encoder.encode(texts, range(len(texts)))
            cuts = [_split(t) for t in texts]
            drawn = iter(encoder._keys(cuts, range(len(texts))).tolist())
            for cut, ids in zip(cuts, got):
                alone = [_with_bytes(encode_chunk(chunk, next(drawn), dropout, load()), load()) for chunk in cut]
                assert sum(alone, []) == ids.tolist()


def test_chunks_end_where_no_piece_reaches_over():
    plain = re.compile(rf" *[^ \n{_MARKS}]*[{_LETTERS}](?=[{_MARKS}])| +[^ \n]*|\n|[^ \n]+")
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choices("ab ,.\n 1é*$-;?|▁一\t×", k=rng.randrange(12)))
        assert plain.findall(" " + text) == _CHUNK.findall(" " + text)
    assert _split("Yes, two  words.\n\n…and, 3, ") == [" Yes", ",", " two", "  words", ".", "\n", "\n", "…and", ",", " 3,", " "]
    encoder = Encoder(load())
    encoder.encode(["a b a", "c a"], [1, 2])
    assert encoder.known == {" a": 0, " b": 1, " c": 2} and len(encoder.roots) == 3
