"""Language identification by unigram pieces, with all segmentations of a word summed.

A word is a run of letters of any length, lower-cased, with a space before it. The pieces are all those
of a public vocabulary file that lower-cased text can hold. For each language a piece has a
probability, and a word's probability is the sum over all ways to cut it into pieces of the product of
their probabilities, by the forward algorithm; over a long word only the last forward values are
carried, and rescaled before they get too small. Characters outside the vocabulary have the same small
probability in every language. A text's language is the one with the largest product of its words'
probabilities and the language's share of the training documents.

Piece probabilities are learnt by expectation maximisation, from equal ones on, over the words of a
bounded sample of training documents: about ``SAMPLE_DOCS`` of each language, chosen by a hash of the
id (repeated ids are chosen together). Languages, sources and ids are never read when a text is scored. Scoring reads whole texts.

A null text, or one without a letter, gets ``und`` and score 0, and so does every text if there is
nothing to learn from. Equal scores go to the language that comes first by name. Repeated rows are
scored each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.durable import durable
from ledgerlane.llm.pieces import MODEL_PATH, load
from ledgerlane.llm.tables import id_remainder

HELD_OUT = (3, 1)
UNDETERMINED = "und"
#: Pieces up to this length are looked up at every place, longer ones only where their beginning occurs.
SHORT_PIECE = 6
#: Words up to this length need no rescaling: no product over them gets too small for a double.
PLAIN_WORD = 32
#: Positions of a long word that are looked up at once.
WORD_BLOCK = 1 << 16
SAMPLE_DOCS = 1500
EM_ROUNDS = 3
#: Added to every piece's expected count.
SMOOTHING = 0.05
#: Probability of a character that no piece covers, and share of each language's mass that it takes.
UNKNOWN = 1e-7
BLOCK_CHARS = 1 << 22

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The words of a text, as they are scored."""
    return [" " + w for w in _WORD.findall((text or "").lower())]


@dataclass(frozen=True)
class Found:
    """Pieces in words of one length: ``short`` [length - 1, word, last position] has a piece or ``size``; ``ending`` and
    ``starting`` have, per last and per first position, the longer ones as (length, words, pieces)."""

    short: np.ndarray
    ending: list[list[tuple[int, np.ndarray, np.ndarray]]]
    starting: list[list[tuple[int, np.ndarray, np.ndarray]]]


class Vocabulary:
    """All pieces that lower-cased text can hold, found by a hash of their code points."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str):
        texts = sorted(p for p in load(path).ids if p == p.lower())
        hashes = np.array([self._hash_of(t) for t in texts], dtype=np.uint64)
        order = np.argsort(hashes)
        self.texts = [texts[k] for k in order.tolist()]
        self.hashes = hashes[order]
        if len(np.unique(self.hashes)) < len(texts):
            raise ValueError("two pieces have one hash")
        self.size = len(texts)
        self.longest = max(map(len, texts))
        # Beginnings of longer pieces, by length; a hash that agrees by chance only costs a further look.
        self.beginnings = {
            n: np.unique(np.array([self._hash_of(t[:n]) for t in texts if len(t) >= n], dtype=np.uint64))
            for n in range(SHORT_PIECE + 1, self.longest + 1)
        }

    @classmethod
    def _hash_of(cls, text: str) -> np.uint64:
        total = np.zeros(1, dtype=np.uint64)
        for c in text:
            total = total * cls.BASE + np.uint64(ord(c))
        return total[0]

    @staticmethod
    def _among(sorted_hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the sorted hashes, and whether the hash is there."""
        at = np.searchsorted(sorted_hashes, wanted)
        at[at == len(sorted_hashes)] = 0
        return at, sorted_hashes[at] == wanted

    def pieces_in(self, codes: np.ndarray) -> Found:
        """All pieces in words [word, position] of code points."""
        rows, width = codes.shape
        short = np.full((SHORT_PIECE, rows, width), self.size, dtype=np.int32)
        sums = np.zeros((rows, width + 1), dtype=np.uint64)
        for t in range(width):
            sums[:, t + 1] = sums[:, t] * self.BASE + codes[:, t]
        power = np.uint64(1)
        for k in range(1, min(SHORT_PIECE, width) + 1):
            power = power * self.BASE
            at, there = self._among(self.hashes, sums[:, k:] - sums[:, : width + 1 - k] * power)
            short[k - 1, :, k - 1 :] = np.where(there, at, self.size)
        ending: list[list] = [[] for _ in range(width)]
        starting: list[list] = [[] for _ in range(width)]
        start, row = (grid.ravel() for grid in np.meshgrid(np.arange(width), np.arange(rows)))
        for k in range(SHORT_PIECE + 1, min(self.longest, width) + 1):
            power = power * self.BASE
            fits = start + k <= width
            start, row = start[fits], row[fits]
            wanted = sums[row, start + k] - sums[row, start] * power
            begun = self._among(self.beginnings[k], wanted)[1]
            start, row, wanted = start[begun], row[begun], wanted[begun]
            at, there = self._among(self.hashes, wanted)
            self._by_place(k, start[there], row[there], at[there], ending, starting)
        return Found(short, ending, starting)

    @staticmethod
    def _by_place(k: int, start: np.ndarray, row: np.ndarray, piece: np.ndarray, ending: list, starting: list) -> None:
        order = np.argsort(start, kind="stable")
        places, firsts = np.unique(start[order], return_index=True)
        for place, own in zip(places.tolist(), np.split(order, firsts[1:])):
            hit = (k, row[own], piece[own])
            starting[place].append(hit)
            ending[place + k - 1].append(hit)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str = MODEL_PATH) -> Vocabulary:
    if path not in _loaded:
        with np.errstate(over="ignore"):
            _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points) of the words of each length, some thousands at once."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for size in np.unique(sizes).tolist():
        places, step = np.flatnonzero(sizes == size), max(1, min(20_000, 640_000 // size))
        for start in range(0, len(places), step):
            own = places[start : start + step]
            joined = "".join([words[i] for i in own.tolist()]).encode("utf-32-le", "surrogatepass")
            yield own, np.frombuffer(joined, dtype="<u4").astype(np.uint64).reshape(len(own), size)


def _own(found: Found, chances: np.ndarray, k: int, last: int) -> np.ndarray:
    """[word, language]: chances of the pieces of k + 1 characters that end at a position."""
    piece = found.short[k, :, last]
    own = chances[piece]
    return np.where((piece == chances.shape[0] - 1)[:, None], UNKNOWN, own) if k == 0 else own


def _forward(found: Found, chances: np.ndarray) -> np.ndarray:
    """[position, word, language]: summed probability of all segmentations up to the position. ``chances``
    [piece, language] ends with a row of zeros for substrings that are no piece."""
    _, rows, width = found.short.shape
    forward = np.zeros((width + 1, rows, chances.shape[1]))
    forward[0] = 1
    for t in range(width):
        for k in range(min(SHORT_PIECE, t + 1)):
            forward[t + 1] += forward[t - k] * _own(found, chances, k, t)
        for length, own, piece in found.ending[t]:
            forward[t + 1][own] += forward[t + 1 - length][own] * chances[piece]
    return forward


class _Rescaled:
    """The last sums of a walk over a long word, all divided by exp(``logs``)."""

    def __init__(self, longest: int, rows: int, languages: int):
        self.window = np.zeros((longest, rows, languages))
        self.window[0] = 1
        self.logs = np.zeros((rows, languages))

    def push(self, total: np.ndarray) -> None:
        self.window = np.concatenate([total[None], self.window[:-1]])
        if total.min() < 1e-60:
            self.logs += np.log(total)
            self.window /= total

    def log(self) -> np.ndarray:
        return self.logs + np.log(self.window[0])


def _log_forward_long(codes: np.ndarray, chances: np.ndarray, pieces: Vocabulary, keep: bool = False) -> np.ndarray:
    """[word, language]: log of the summed probability of long words, looked up block by block; with ``keep``, of
    every beginning, as [position, word, language]."""
    rows, width = codes.shape
    state = _Rescaled(pieces.longest, rows, chances.shape[1])
    kept = [state.log()] if keep else []
    for begin in range(0, width, WORD_BLOCK):
        back = min(begin, pieces.longest - 1)
        found = pieces.pieces_in(codes[:, begin - back : begin + WORD_BLOCK])
        for t in range(back, found.short.shape[2]):
            total = np.zeros_like(state.logs)
            for k in range(min(SHORT_PIECE, t + 1)):
                total += state.window[k] * _own(found, chances, k, t)
            for length, own, piece in found.ending[t]:
                total[own] += state.window[length - 1][own] * chances[piece]
            state.push(total)
            if keep:
                kept.append(state.log())
    return np.stack(kept) if keep else state.log()


def _log_backward_long(found: Found, chances: np.ndarray, longest: int) -> np.ndarray:
    """[position, word, language]: log of the summed probability of every end of long words."""
    _, rows, width = found.short.shape
    state = _Rescaled(longest, rows, chances.shape[1])
    kept = [state.log()]
    for t in range(width - 1, -1, -1):
        total = np.zeros_like(state.logs)
        for k in range(min(SHORT_PIECE, width - t)):
            total += state.window[k] * _own(found, chances, k, t + k)
        for length, own, piece in found.starting[t]:
            total[own] += state.window[length - 1][own] * chances[piece]
        state.push(total)
        kept.append(state.log())
    return np.stack(kept[::-1])


def _backward(found: Found, chances: np.ndarray) -> np.ndarray:
    _, rows, width = found.short.shape
    backward = np.zeros((width + 1, rows, chances.shape[1]))
    backward[width] = 1
    for t in range(width - 1, -1, -1):
        for k in range(min(SHORT_PIECE, width - t)):
            backward[t] += backward[t + k + 1] * _own(found, chances, k, t + k)
        for length, own, piece in found.starting[t]:
            backward[t][own] += backward[t + length][own] * chances[piece]
    return backward


def log_chances(words: list[str], chances: np.ndarray, pieces: Vocabulary) -> np.ndarray:
    """[word, language]: log probability of every word."""
    out = np.zeros((len(words), chances.shape[1]))
    with np.errstate(over="ignore"):
        for places, codes in _by_length(words):
            if codes.shape[1] > PLAIN_WORD:
                out[places] = _log_forward_long(codes, chances, pieces)
            else:
                out[places] = np.log(_forward(pieces.pieces_in(codes), chances)[-1])
    return out


def expected_counts(words: list[str], numbers: np.ndarray, chances: np.ndarray, pieces: Vocabulary) -> np.ndarray:
    """Expected number of uses of every piece in words of one language, by forward and backward sums."""
    total = np.zeros(pieces.size + 1)
    with np.errstate(over="ignore", divide="ignore"):
        for places, codes in _by_length(words):
            found = pieces.pieces_in(codes)
            if codes.shape[1] > PLAIN_WORD:
                before = _log_forward_long(codes, chances, pieces, keep=True)[..., 0]
                after = _log_backward_long(found, chances, pieces.longest)[..., 0]
                whole = before[-1]
                used = lambda s, e, own: np.exp(before[s][own] + after[e][own] - whole[own])  # noqa: B023, E731
            else:
                forward, backward = _forward(found, chances)[..., 0], _backward(found, chances)[..., 0]
                used = lambda s, e, own: forward[s][own] * backward[e][own] / forward[-1][own]  # noqa: B023, E731
            weight, everyone = numbers[places], np.arange(len(places))
            for t in range(codes.shape[1]):
                hits = [(k + 1, everyone, found.short[k, :, t]) for k in range(min(SHORT_PIECE, t + 1))]
                for length, own, piece in [*hits, *found.ending[t]]:
                    share = used(t + 1 - length, t + 1, own) * chances[piece, 0] * weight[own]
                    total += np.bincount(piece, share, minlength=len(total))
    return total[:-1]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    chances: np.ndarray  # piece, language; the last row is 0
    priors: np.ndarray
    path: str

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of every text."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        names, scores = [], []
        for start, stop in _blocks(texts):
            logs, known = self._log_sums(texts[start:stop])
            best = logs.argmax(axis=1)
            shares = np.exp(logs - logs.max(axis=1, keepdims=True))
            own = 1 / shares.sum(axis=1)
            names += [self.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
            scores.append(np.where(known, own, 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)

    def _log_sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        place: dict[str, int] = {}
        uses: list[np.ndarray] = []
        known: list[bool] = []
        for text in texts:
            words = words_of(text)
            known.append(any(c.isalpha() for word in words for c in word))
            fresh = list(set(words).difference(place))
            place.update(zip(fresh, range(len(place), len(place) + len(fresh))))
            uses.append(np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=len(words)))
        by_word = log_chances(list(place), self.chances, vocabulary(self.path))
        sums = np.array([by_word[own].sum(axis=0) for own in uses]).reshape(len(texts), len(self.languages))
        return sums + np.log(self.priors), np.array(known, dtype=bool)


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, total = 0, 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= BLOCK_CHARS:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _sample(training: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """(lang, text) of the training documents whose id hashes below their language's share: about SAMPLE_DOCS
    of each language, or all of a smaller one, chosen row by row."""
    steps = 1 << 30
    shares = [F.when(F.col("lang") == lang, F.lit(min(steps, steps * SAMPLE_DOCS // n))) for lang, n in sizes.items()]
    place = F.pmod(F.xxhash64("own_id"), F.lit(steps))
    return training.where(place < F.coalesce(*shares)).select("lang", "own_text")


def _word_counts(sample: DataFrame) -> DataFrame:
    @F.pandas_udf("array<string>")
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(words_of)

    spread = sample.select("lang", F.explode(words("own_text")).alias("word"))
    return durable(spread.groupBy("lang", "word").agg(F.count("*").alias("n")), "language-words")


def _expected(words: DataFrame, chances: dict[str, np.ndarray], path: str) -> DataFrame:
    """(lang, piece, uses) expected under the present chances."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        for batch in batches:
            rows = batch.to_pandas()
            for lang, own in rows.groupby("lang"):
                uses = expected_counts(own["word"].tolist(), own["n"].to_numpy(dtype=float), chances[lang][:, None], pieces)
                used = np.flatnonzero(uses)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(uses[used])],
                    names=["lang", "piece", "uses"],
                )

    counted = words.mapInArrow(count, "lang string, piece int, uses double")
    return counted.groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))


def learn(docs: DataFrame, path: str = MODEL_PATH) -> LanguageModel:
    """The model from (own_id, lang, own_text) rows of the training part."""
    modulus, held_out = HELD_OUT
    training = docs.where((id_remainder(F.col("own_id"), modulus) != held_out) & F.col("lang").isNotNull())
    shares = {r.lang: r.n for r in training.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(shares)
    size = vocabulary(path).size
    chances = {lang: np.append(np.full(size, 1.0 / size), 0.0) for lang in languages}
    if languages:
        words = _word_counts(_sample(training, shares))
        for _ in range(EM_ROUNDS):
            # At most one row per language and piece.
            rows = _expected(words, chances, path).toPandas()
            for lang in languages:
                own = rows[rows["lang"] == lang]
                counts = np.full(size, SMOOTHING)
                counts[own["piece"].to_numpy(dtype=np.int64)] += own["uses"].to_numpy(dtype=float)
                chances[lang] = np.append((1 - UNKNOWN) * counts / counts.sum(), 0.0)
    table = np.stack([chances[lang] for lang in languages], axis=1) if languages else np.zeros((size + 1, 0))
    priors = np.array([shares[lang] for lang in languages], dtype=float)
    return LanguageModel(languages, table, priors / max(priors.sum(), 1.0), path)


def identify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    path: str = MODEL_PATH,
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred and score (the posterior probability of lang_pred)."""
    own = docs.select(
        F.col(id_column).cast("long").alias("own_id"), F.col(lang_column).alias("lang"), F.col(text_column).alias("own_text")
    )
    model = learn(own, path)
    modulus, held_out = HELD_OUT
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per language and piece

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    predicted: Column = predict("own_text")
    return own.select(
        F.col("own_id").alias("doc_id"),
        (id_remainder(F.col("own_id"), modulus) == held_out).alias("held_out"),
        predicted.alias("found"),
    ).select("doc_id", "held_out", "found.*")
