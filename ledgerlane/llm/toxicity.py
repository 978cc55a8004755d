"""Toxicity by weak supervision.

Many voters look at a text: lexicons of abuse, a lexicon of word stems learnt from the labelled part,
and patterns. Each votes toxic, clean or abstains; a row's label, where it has one in the training part, is
one more vote. A generative model of the votes estimates how accurate every voter is, the label
included, and how strongly voters are correlated given the class, by expectation maximisation;
correlated voters share their weight. Its posterior alone trains a linear classifier over what the
voters counted, which scores all texts.

Stems are learnt from a bounded sample of labelled rows; vote counts and the classifier's sums are added
up over all rows of the training part.
Ids, languages, sources and labels are never read by the score.

Null and empty texts hold no word; every lexicon finds nothing in them. Repeated rows are scored each.
Without labelled rows the learnt lexicon is empty and the voters start from assumed accuracies; with
no rows at all to learn from, the score is that of the assumed voters.
"""

from __future__ import annotations

import re
from collections import Counter as Tally
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions.durable import drop_durable, durable
from ledgerlane.llm.memory import give_back, mapped
from ledgerlane.llm.tables import id_remainder

HELD_OUT = 5
THRESHOLD = 0.5
#: Stems are the first characters of a word.
STEM_LENGTHS = (4, 5, 6)
#: A stem enters the lexicon if so many toxic documents of the sample hold it, and such a share of them, and
#: if of all labelled documents that hold it so large a share is toxic. The share bounds the lexicon: it holds at
#: most 1 / STEM_SHARE times the stems of an average toxic document.
STEM_DOCUMENTS, STEM_SHARE, STEM_PRECISION = 5, 0.01, 0.98
#: Labelled rows of each class that stems are learnt from: those whose id has the smallest hash.
SAMPLE_ROWS = 10_000
EM_ROUNDS = 25
NEWTON_ROUNDS = 12
RIDGE = 1.0
BLOCK_CHARS = 1 << 20
#: Words whose kind a task remembers.
REMEMBERED_WORDS = 100_000
#: Stems that a task counts before it hands its counts on.
STEMS_AT_ONCE = 200_000

#: Lexicons of common English abuse.
LEXICONS: dict[str, tuple[str, ...]] = {
    "insult_nouns": (
        "clown", "coward", "creep", "cretin", "dimwit", "dork", "dunce", "dummy", "fool", "freak", "garbage", "idiot", "idiots",
        "imbecile", "jerk", "loser", "losers", "lowlife", "maggot", "moron", "morons", "parasite", "scum", "scumbag",
        "simpleton", "trash", "twit", "vermin", "weirdo", "wimp",
    ),
    "insult_adjectives": (
        "brainless", "contemptible", "despicable", "disgusting", "dumb", "filthy", "hideous", "idiotic", "moronic",
        "pathetic", "repulsive", "revolting", "stupid", "ugly", "useless", "vile", "worthless", "wretched",
    ),
    "threats": ("choke", "hurt", "kill", "murder", "shoot", "smash", "stab", "strangle"),
    "profanity": ("arse", "ass", "asshole", "bastard", "bitch", "bullshit", "crap", "damn", "fuck", "fucking", "piss", "shit", "slut", "whore"),
}

_WORD = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"!{2,}|\?{2,}")
_AIMED = re.compile(r"\b(?:you|your|he|she|they)\b(?:\W+\w+){0,3}?\W+$")

#: What is counted in a text, per lexicon and pattern.
COUNTS = [*LEXICONS, "stems_even", "stems_odd", "aimed", "shouts", "words"]
TOXIC, CLEAN, ABSTAIN = 1, 0, 2
VOTERS = ["insult_nouns", "insult_adjectives", "threats", "profanity", "stems_even", "stems_odd", "aimed", "repeated", "shouting", "nothing_found", "label"]
#: Assumed chances of (clean, toxic, abstain) votes given clean and given toxic, where nothing is known.
ASSUMED = np.array(
    [[[0.0, 0.05, 0.95], [0.0, 0.4, 0.6]]] * 9 + [[[0.8, 0.0, 0.2], [0.1, 0.0, 0.9]], [[0.38, 0.02, 0.6], [0.02, 0.38, 0.6]]]
)
ASSUMED_ROWS = 4.0


def text_blocks(text: str) -> Iterator[str]:
    """A text in parts cut after white space, each about BLOCK_CHARS long unless a word is longer."""
    start = 0
    while start < len(text):
        end = min(len(text), start + BLOCK_CHARS)
        while end < len(text) and not text[end - 1].isspace():
            end += 1
        yield text[start:end]
        start = end


class Counter:
    """Counts lexicon words, learnt stems and patterns in texts."""

    def __init__(self, stems: dict[str, int]):
        self.lexicon_of = {w: k for k, words in enumerate(LEXICONS.values()) for w in words}
        self.stems = stems  # stem -> 0 or 1, its half of the lexicon
        self.known: dict[str, int] = {}

    def _kind(self, word: str) -> int:
        """The count that a word adds to: 0 is none."""
        kind = self.lexicon_of.get(word, -1) + 1
        if not kind:
            half = next((self.stems[word[:n]] for n in reversed(STEM_LENGTHS) if word[:n] in self.stems and len(word) >= n), None)
            kind = 0 if half is None else len(LEXICONS) + half + 1
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        self.known[word] = kind
        return kind

    def counts(self, text: str | None) -> list[float]:
        found = np.zeros(len(COUNTS))
        for block in text_blocks((text or "").lower()):
            words = _WORD.findall(block)
            kinds = [self.known.get(w, -1) for w in words]
            if -1 in kinds:
                kinds = [self._kind(w) if k < 0 else k for k, w in zip(kinds, words)]
            tally = np.bincount(kinds, minlength=len(LEXICONS) + 3) if kinds else np.zeros(len(LEXICONS) + 3)
            found[: len(LEXICONS) + 2] += tally[1:]
            if tally[1 : len(LEXICONS) + 1].sum():
                abuse = {w for w, k in zip(words, kinds) if 1 <= k <= len(LEXICONS)}
                places = re.finditer(r"\b(?:" + "|".join(sorted(abuse)) + r")\b", block)
                found[-3] += sum(_AIMED.search(block[max(0, m.start() - 40) : m.start()]) is not None for m in places)
            found[-2] += sum(1 for _ in _SHOUT.finditer(block))
            found[-1] += len(words)
        return found.tolist()


def votes(counts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Votes of all VOTERS for rows of COUNTS with labels (0, 1, or -1 for none)."""
    out = np.full((len(counts), len(VOTERS)), ABSTAIN, dtype=np.int8)
    hits = counts[:, : len(LEXICONS) + 2]
    out[:, : len(LEXICONS) + 3][counts[:, : len(LEXICONS) + 3] > 0] = TOXIC
    out[hits.sum(axis=1) >= 3, VOTERS.index("repeated")] = TOXIC
    out[(counts[:, -2] >= 1) & (hits.sum(axis=1) >= 1), VOTERS.index("shouting")] = TOXIC
    out[hits.sum(axis=1) == 0, VOTERS.index("nothing_found")] = CLEAN
    out[labels == 1, VOTERS.index("label")] = TOXIC
    out[labels == 0, VOTERS.index("label")] = CLEAN
    return out


@dataclass(frozen=True)
class LabelModel:
    """P(vote | class) per voter, weights that share what correlated voters say, and P(toxic)."""

    chances: np.ndarray  # voter, class, vote
    weights: np.ndarray  # voter
    correlations: np.ndarray  # voter, voter
    prior: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = np.log(self.chances)
        ratio = np.full(len(patterns), np.log(self.prior) - np.log1p(-self.prior))
        for j, weight in enumerate(self.weights):
            ratio += weight * (logs[j, 1] - logs[j, 0])[patterns[:, j]]
        return 1 / (1 + np.exp(-np.clip(ratio, -500, 500)))


def fit_label_model(patterns: np.ndarray, n: np.ndarray) -> LabelModel:
    """From distinct vote patterns with their numbers of rows.

    No row's class is taken as known: classes and the voters' chances are estimated in turn, from assumed
    chances on. A voter's weight is one over its summed absolute correlations, within classes, with all voters.
    """
    voters = patterns.shape[1]
    smooth = (ASSUMED + 0.02) / (ASSUMED + 0.02).sum(axis=2, keepdims=True)
    model = LabelModel(smooth, np.ones(voters), np.eye(voters), 0.1)
    for _ in range(EM_ROUNDS):
        toxic = model.posterior(patterns)
        chances = smooth * ASSUMED_ROWS
        by_class = np.stack([n * (1 - toxic), n * toxic])
        for j in range(voters):
            for vote in (CLEAN, TOXIC, ABSTAIN):
                chances[j, :, vote] += by_class[:, patterns[:, j] == vote].sum(axis=1)
        chances /= chances.sum(axis=2, keepdims=True)
        correlations = _correlations(patterns, by_class)
        prior = float(np.clip((by_class[1].sum() + 1) / (n.sum() + 10), 1e-4, 1 - 1e-4))
        model = LabelModel(chances, 1 / np.abs(correlations).sum(axis=1), correlations, prior)
    return model


def _correlations(patterns: np.ndarray, by_class: np.ndarray) -> np.ndarray:
    """Correlation of voters' toxic or clean votes within the classes, pooled over both."""
    said = (patterns == TOXIC) * 1.0 - (patterns == CLEAN)
    covariance = np.zeros((patterns.shape[1],) * 2)
    for weights in by_class:
        total = max(weights.sum(), 1e-9)
        centred = said - (weights @ said) / total
        covariance += (centred * weights[:, None]).T @ centred
    scale = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
    correlation = covariance / scale / scale[:, None]
    np.fill_diagonal(correlation, 1.0)
    return correlation


def features(counts: np.ndarray) -> np.ndarray:
    """A constant; presence, logarithm and density of every lexicon and pattern; presence and density of any
    abuse. Densities take short texts as a little longer than they are."""
    found, words = counts[:, :-1], counts[:, -1:]
    abuse = found[:, : len(LEXICONS) + 2].sum(axis=1, keepdims=True)
    density = np.log1p(100 * found / (words + 20))
    return np.hstack([np.ones((len(counts), 1)), found > 0, np.log1p(found), density, abuse > 0, np.log1p(100 * abuse / (words + 20))])


@dataclass(frozen=True)
class ToxicityModel:
    stems: dict[str, int]
    labels: LabelModel
    weights: np.ndarray

    def score(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(counts) @ self.weights, -500, 500)))


def _keyed_labels(labels: DataFrame) -> DataFrame:
    usable = id_remainder(F.col("doc_id"), HELD_OUT) != 0
    return labels.where(usable & F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("label")
    )


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of (label, text) rows that hold each stem, counted within the task as far as memory is kept
    small: (stem, toxic, clean)."""
    tallies = (Tally(), Tally())

    def partial() -> pa.RecordBatch:
        stems = list(tallies[0].keys() | tallies[1].keys())
        columns = [pa.array(stems, pa.string()), *(pa.array([tallies[k][s] for s in stems], pa.int64()) for k in (1, 0))]
        return pa.RecordBatch.from_arrays(columns, names=["stem", "toxic", "clean"])

    for batch in batches:
        for label, text in zip(*batch.columns):
            words = {w for block in text_blocks((text.as_py() or "").lower()) for w in _WORD.findall(block)}
            tallies[label.as_py()].update({w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n})
            if len(tallies[0]) + len(tallies[1]) > STEMS_AT_ONCE:
                yield partial()
                tallies = (Tally(), Tally())
    yield partial()
    del tallies
    give_back()


def learnt_stems(docs: DataFrame, known: DataFrame) -> dict[str, int]:
    """Stems that tell toxic labelled documents (own_id, own_text) from clean ones, with the half of the lexicon
    each belongs to. Learnt from SAMPLE_ROWS labelled rows per class."""
    samples = [
        known.where(F.col("label") == label).orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE_ROWS)
        for label in (0, 1)
    ]
    sample = durable(samples[0].union(samples[1]), "toxicity-sample")
    count = F.count("*").alias("n")
    totals = {r.label: r.n for r in sample.groupBy("label").agg(count).collect()}
    overall = {r.label: r.n for r in known.groupBy("label").agg(count).collect()}
    if len(totals) < 2:
        return {}

    # The sample is at most 2 * SAMPLE_ROWS pairs of numbers.
    texts = docs.join(F.broadcast(sample), docs["own_id"] == sample["label_id"]).select("label", "own_text")
    parts = texts.mapInArrow(_stem_counts, "stem string, toxic long, clean long")
    counted = parts.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # Both classes' documents in the labelled rows, as far as the sample tells.
    toxic_rows, clean_rows = F.col("toxic") * (overall[1] / totals[1]), F.col("clean") * (overall[0] / totals[0])
    rows = (
        counted.where(F.col("toxic") >= max(STEM_DOCUMENTS, STEM_SHARE * totals[1]))
        .where(toxic_rows >= STEM_PRECISION * (toxic_rows + clean_rows))
        .select("stem")
        .collect()
    )
    return {r.stem: xxhash.xxh64_intdigest(r.stem) % 2 for r in rows}


def counts_column(stems: dict[str, int], text: Column) -> Column:
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(stems)
        return mapped(lambda texts: texts.map(counter.counts), batches)

    return counted(text)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(COUNTS))


def _fit_labels(training: DataFrame) -> LabelModel:
    """From the training rows (counts, label or -1), first reduced to distinct vote patterns. Voters but the label
    say one of two things each, so there are at most 3 * 2^10 of them."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = votes(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
            texts = ["".join(map(str, row)) for row in rows.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["pattern"])

    found = training.select("counts", "label").mapInArrow(vote, "pattern string")
    rows = found.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").toPandas()
    patterns = np.array([[int(c) for c in p] for p in rows["pattern"]], dtype=np.int8).reshape(-1, len(VOTERS))
    return fit_label_model(patterns, rows["n"].to_numpy(dtype=float))


def _fit_classifier(training: DataFrame, labels: LabelModel) -> np.ndarray:
    """Logistic regression on the posterior by Newton's method; tasks add up gradients and Hessians."""
    d = features(np.zeros((1, len(COUNTS)))).shape[1]
    weights = np.zeros(d)

    def step(weights: np.ndarray):
        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(d + d * d)
            for batch in batches:
                counts, label = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
                target = labels.posterior(votes(counts, label))
                x = features(counts)
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
                total[:d] += x.T @ (target - p)
                total[d:] += ((x * (p * (1 - p))[:, None]).T @ x).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["place", "value"])

        return add_up

    for _ in range(NEWTON_ROUNDS):
        parts = training.select("counts", "label").mapInArrow(step(weights), "place int, value double")
        rows = parts.groupBy("place").agg(F.sum("value").alias("value")).toPandas()  # d + d * d numbers
        total = np.zeros(d + d * d)
        total[rows["place"]] = rows["value"]
        gradient = total[:d] - RIDGE * weights
        change = np.linalg.solve(total[d:].reshape(d, d) + RIDGE * np.eye(d), gradient)
        weights = weights + change
        if np.abs(change).max() < 1e-3:
            break
    return weights


def _counts_and_model(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, ToxicityModel]:
    """Rows of (own_id, counts), written, and the model learnt from them."""
    known = _keyed_labels(labels)
    own = docs.select(F.col(id_column).cast("long").alias("own_id"), F.col(text_column).alias("own_text"))
    stems = learnt_stems(own, known)
    rows = durable(own.select("own_id", counts_column(stems, F.col("own_text")).alias("counts")), "toxicity-counts")
    # Rows without an id cannot be held out by it, nor have a label; nothing is learnt from them.
    usable = rows.where(id_remainder(F.col("own_id"), HELD_OUT) != 0)
    training = durable(
        usable.join(known, usable["own_id"] == known["label_id"], "left").select(
            "counts", F.coalesce("label", F.lit(-1)).alias("label")
        ),
        "toxicity-training",
    )
    model = _fit_labels(training)
    weights = _fit_classifier(training, model)
    drop_durable(training)
    return rows, ToxicityModel(stems, model, weights)


def score_column(model: ToxicityModel, counts: Column) -> Column:
    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(rows.tolist(), dtype=float).reshape(len(rows), len(COUNTS))))

    return score(counts)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (higher: label 1 likelier) and predicted."""
    rows, model = _counts_and_model(docs, labels, id_column, text_column)
    return rows.select(
        F.col("own_id").alias("doc_id"),
        (id_remainder(F.col("own_id"), HELD_OUT) == 0).alias("held_out"),
        score_column(model, F.col("counts")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic. Texts are counted once for the fit and once more for the decisions, each
    in place: leaving toxic rows out by their ids would shuffle every text as soon as the ids are too many to broadcast."""
    rows, model = _counts_and_model(docs, labels, "doc_id", "text")
    drop_durable(rows)
    return docs.where(score_column(model, counts_column(model.stems, F.col("text"))) < THRESHOLD)
