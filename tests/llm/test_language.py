"""The forward algorithm against a sum over all segmentations; held-out accuracy."""

import math
import zlib
from fractions import Fraction

import numpy as np

from ledgerlane.llm import language
from ledgerlane.llm.language import UNKNOWN, expected_counts, identify, log_chances, vocabulary, words_of
from ledgerlane.llm.pieces import load


def segmentations(word, pieces):
    """All ways to cut a word; a character that is no piece stands alone."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in pieces or k == 1:
            for rest in segmentations(word[k:], pieces):
                yield [word[:k], *rest]


def model(seed):
    v = vocabulary()
    chances = np.random.default_rng(seed).random((v.size + 1, 2))
    chances[-1] = 0
    return v, chances / chances.sum(axis=0), {t: i for i, t in enumerate(v.texts)}


WORDS = [" the", " thing", " ßx", " 日本", " éouele", " a", " ", " understanding", " responsibility"]


def exact_log(word, of, longest):
    """Log of the sum over all segmentations, in fractions, so that no length is too much."""
    sums = [Fraction(1)]
    for end in range(1, len(word) + 1):
        cuts = range(max(0, end - longest), end)
        sums.append(sum(sums[s] * Fraction(of(word[s:end])) for s in cuts))
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator), sums


def test_all_segmentations_are_summed():
    v, chances, place = model(1)
    got = log_chances(WORDS, chances, v)
    for word, row in zip(WORDS, got):
        for lang in (0, 1):
            of = lambda p: chances[place[p], lang] if p in place else UNKNOWN  # noqa: B023, E731
            total = sum(np.prod([of(p) for p in cut]) for cut in segmentations(word, place))
            assert np.isclose(row[lang], np.log(total))


def test_expected_counts():
    v, chances, place = model(2)
    got = expected_counts(WORDS, np.array([1.0, 2, 1, 1, 3, 1, 1, 2, 1]), chances[:, :1], v)
    want = np.zeros(v.size)
    for word, n in zip(WORDS, [1, 2, 1, 1, 3, 1, 1, 2, 1]):
        cuts = list(segmentations(word, place))
        weights = [np.prod([chances[place[p], 0] if p in place else UNKNOWN for p in cut]) for cut in cuts]
        for cut, weight in zip(cuts, weights):
            for p in cut:
                if p in place:
                    want[place[p]] += n * weight / sum(weights)
    assert np.allclose(got, want)


def test_the_whole_vocabulary_takes_part():
    v, _, place = model(1)
    assert v.longest == max(map(len, place)) > language.SHORT_PIECE
    assert set(place) == {p for p in load(language.MODEL_PATH).ids if p == p.lower()}
    long_pieces = [t for t in v.texts if len(t) > language.SHORT_PIECE]
    codes = np.array([[ord(c) for c in "x" + t + "y" * (v.longest - len(t))] for t in long_pieces], dtype=np.uint64)
    with np.errstate(over="ignore"):
        found = v.pieces_in(codes)
    for row, text in enumerate(long_pieces):
        hits = [piece[own == row] for length, own, piece in found.starting[1] if length == len(text)]
        assert place[text] in np.concatenate(hits).tolist()


LONG = [" " + "understandingresponsibility" * 4, " " + "日本語のとても長い" * 30, " " + "ß" * 500, " " + "qx" * 50 + "international" * 3]


def test_words_of_any_length_are_summed_whole(monkeypatch):
    v, chances, place = model(3)
    for block in (1 << 16, 37):
        monkeypatch.setattr(language, "WORD_BLOCK", block)
        got = log_chances([*LONG, *WORDS], chances, v)
        for word, row in zip(LONG, got):
            for lang in (0, 1):
                of = lambda p: chances[place[p], lang] if p in place else UNKNOWN if len(p) == 1 else 0  # noqa: B023, E731
                assert np.isclose(row[lang], exact_log(word, of, v.longest)[0])
    assert words_of("Ab1c " + "x" * 70) == [" ab", " c", " " + "x" * 70]
    assert words_of(None) == words_of("12 !?") == []


def test_expected_counts_of_long_words():
    v, chances, place = model(4)
    of = lambda p: Fraction(chances[place[p], 0]) if p in place else Fraction(UNKNOWN) if len(p) == 1 else 0
    got = expected_counts(LONG[:2], np.array([1.0, 2]), chances[:, :1], v)
    want = np.zeros(v.size)
    for word, n in zip(LONG[:2], (1, 2)):
        before, after = exact_log(word, of, v.longest)[1], [Fraction(1)]
        for start in range(len(word) - 1, -1, -1):
            after.append(sum(of(word[start : start + k]) * after[len(after) - k] for k in range(1, min(v.longest, len(after)) + 1)))
        after = after[::-1]
        for s in range(len(word)):
            for e in range(s + 1, min(len(word), s + v.longest) + 1):
                if word[s:e] in place:
                    want[place[word[s:e]]] += float(n * before[s] * of(word[s:e]) * after[e] / before[-1])
    assert np.allclose(got, want)


def test_learning_and_prediction_against_plain_sums(spark):
    rows = [(k, ("the cat sat on the mat", "le chat est sur la table")[k % 2], ("en", "fr")[k % 2]) for k in range(40)]
    docs = spark.createDataFrame(rows, "own_id long, own_text string, lang string")
    trained = language.learn(docs)
    v = vocabulary()
    for lang, text in (("en", rows[0][1]), ("fr", rows[1][1])):
        used = [t for k, t, of in rows if of == lang and zlib.crc32(str(k).encode()) % 3 != 1]
        words = words_of(" ".join(used))
        chances = np.append(np.full(v.size, 1 / v.size), 0.0)
        for _ in range(language.EM_ROUNDS):
            counts = language.SMOOTHING + expected_counts(words, np.ones(len(words)), chances[:, None], v)
            chances = np.append((1 - UNKNOWN) * counts / counts.sum(), 0.0)
        assert np.allclose(trained.chances[:, trained.languages.index(lang)], chances)
    texts = ["the chat", "la mat mat"]
    logs = np.array([log_chances(words_of(t), trained.chances, v).sum(axis=0) for t in texts]) + np.log(trained.priors)
    shares = np.exp(logs) / np.exp(logs).sum(axis=1, keepdims=True)
    names, scores = trained.predict(texts)
    assert names == [trained.languages[k] for k in shares.argmax(axis=1)] and np.allclose(scores, shares.max(axis=1))


def test_held_out_accuracy(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert len(held) > 30
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_nulls_repeats_and_empty_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame(
        [(-1, None, "en", 1), (None, "", None, 2), (-3, "12 ½² !", "fr", 3), (None, "the thing", None, 4), (None, "the thing", None, 4)],
        "doc_id long, text string, lang string, score int",
    )
    got = identify(docs.unionByName(extra, allowMissingColumns=True)).where("doc_id is null or doc_id < 0").collect()
    found = sorted((str(r.doc_id), r.lang_pred) for r in got)
    assert found == [("-1", "und"), ("-3", "und"), ("None", "en"), ("None", "en"), ("None", "und")]
    assert {r.score for r in got if r.lang_pred == "und"} == {0.0}
    assert identify(docs.limit(0)).count() == 0
    nothing_learnt = identify(docs.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in nothing_learnt.collect()} == {"und"}
