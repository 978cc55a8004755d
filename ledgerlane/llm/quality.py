"""Quality by a regularised quadratic discriminant over document statistics.

Every text is reduced to a few statistics (shares of kinds of characters and words, repetition,
lengths), shrunk towards neutral values for short texts and put on a log scale. Each class has a mean
and a covariance, shrunk towards the pooled covariance and a multiple of the identity; their Cholesky
factors are computed once and sent along with the scoring function. The score is the posterior
probability of label 1 from the difference of the two log-densities.

Counts, sums and sums of products per class are added up over all labelled rows of the training
part, so nothing is sampled. Ids, languages, sources and labels are never read by the score.

A null or empty text has the statistics of a text without words. Repeated rows are scored each. With
no labelled row of a class, scores are the share of label 1 (1 without any label). An id labelled
more than once counts with each of its labels; null labels do not count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions.durable import drop_durable, durable
from ledgerlane.llm.memory import mapped
from ledgerlane.llm.tables import id_remainder

HELD_OUT = 5
THRESHOLD = 0.3
#: Weight of the pooled covariance, and of the identity, in a class's covariance.
POOLED, IDENTITY = 0.1, 0.02
#: Words, or characters, that neutral values count for in shares.
NEUTRAL_WORDS, NEUTRAL_CHARS = 20.0, 120.0
BLOCK_CHARS = 1 << 20

STATISTICS = [
    "upper", "digits", "symbols", "bars", "exclamations", "stops", "spaces", "lines",
    "adjacent_repeats", "top_word", "distinct_words", "word_length", "length",
]


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a text, in the order of STATISTICS."""
    text = text or ""
    bytes_seen = np.zeros(256, dtype=np.int64)
    n_words = repeats = letters = 0
    counts: Counter[str] = Counter()
    last = ""
    for block in _blocks(text):
        data = np.frombuffer(block.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        bytes_seen += np.bincount(data, minlength=256)
        words = block.split()
        n_words += len(words)
        repeats += sum(map(str.__eq__, words, [last, *words])) if words else 0
        counts.update(words)
        last = words[-1] if words else last
        letters += len(block)
    spaces = int(bytes_seen[[9, 10, 11, 12, 13, 32]].sum())
    digits = int(bytes_seen[48:58].sum())
    upper = int(bytes_seen[ord("A") : ord("Z") + 1].sum())
    symbols = int(bytes_seen[[ord(c) for c in "#$%&*@^~+=<>_\\/{}[]"]].sum())
    share = lambda n, of, neutral, weight: (n + neutral * weight) / (of + weight)
    by_char = lambda n, neutral: share(n, letters, neutral, NEUTRAL_CHARS)
    by_word = lambda n, neutral: share(n, n_words, neutral, NEUTRAL_WORDS)
    logged = lambda x: float(np.log1p(100 * x))
    top = max(counts.values(), default=0)
    # Expected repetition grows slowly with length, so distinct words are compared with a power law.
    expected = max(1.0, n_words**0.85)
    return [
        logged(by_char(upper, 0.02)),
        logged(by_char(digits, 0.0)),
        logged(by_char(symbols, 0.0)),
        logged(by_word(int(bytes_seen[ord("|")]), 0.0)),
        logged(by_word(int(bytes_seen[ord("!")]), 0.0)),
        logged(by_word(int(bytes_seen[ord(".")]), 0.1)),
        logged(by_char(spaces, 0.17)),
        logged(by_word(int(bytes_seen[10]), 0.02)),
        logged(by_word(repeats, 0.0)),
        logged(by_word(top, 0.06)),
        float(np.log((len(counts) + NEUTRAL_WORDS) / (expected + NEUTRAL_WORDS))),
        float(np.log((letters - spaces + 5.0 * NEUTRAL_WORDS) / (n_words + NEUTRAL_WORDS))),
        float(np.log1p(n_words)) / 4,
    ]


def _blocks(text: str) -> Iterator[str]:
    """A text in parts cut after white space, each about BLOCK_CHARS long unless a word is longer."""
    start = 0
    while start < len(text):
        end = min(len(text), start + BLOCK_CHARS)
        while end < len(text) and not text[end - 1].isspace():
            end += 1
        yield text[start:end]
        start = end


@dataclass(frozen=True)
class Gaussian:
    mean: np.ndarray
    inverse_factor: np.ndarray  # of the covariance's Cholesky factor
    log_weight: float  # log prior minus half the log determinant

    def log_density(self, x: np.ndarray) -> np.ndarray:
        scaled = (x - self.mean) @ self.inverse_factor.T
        return self.log_weight - 0.5 * (scaled**2).sum(axis=1)


@dataclass(frozen=True)
class Discriminant:
    classes: tuple[Gaussian, Gaussian] | None
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.share)
        difference = self.classes[1].log_density(x) - self.classes[0].log_density(x)
        return 1 / (1 + np.exp(-np.clip(difference, -500, 500)))


def fitted(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant:
    """From each class's number of rows, sum of statistics and sum of their products."""
    share = float(counts[1] / counts.sum()) if counts.sum() else 1.0
    if counts.min() < 2:
        return Discriminant(None, share)
    means = sums / counts[:, None]
    scatter = products - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(axis=0) / counts.sum()
    classes = []
    for k in range(2):
        own = (1 - POOLED) * scatter[k] / counts[k] + POOLED * pooled
        level = max(float(np.trace(own)) / len(own), 1e-6)
        factor = np.linalg.cholesky((1 - IDENTITY) * own + IDENTITY * level * np.eye(len(own)))
        weight = float(np.log(counts[k] / counts.sum()) - np.log(np.diag(factor)).sum())
        classes.append(Gaussian(means[k], np.linalg.inv(factor), weight))
    return Discriminant((classes[0], classes[1]), share)


def training_labels(labels: DataFrame, label: str, held_out: int = HELD_OUT) -> DataFrame:
    """(label_id, label) of the rows that may be learnt from."""
    usable = id_remainder(F.col("doc_id"), held_out) != 0
    return labels.where(usable & F.col(label).isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("label_id"), F.col(label).cast("int").alias("label")
    )


def fit(statistics_rows: DataFrame) -> Discriminant:
    """Learn from (statistics, label) rows: tasks add up their own, Spark adds up the tasks', and the driver
    gets one number per class and sum."""
    d = len(STATISTICS)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = x[y == k]
                sums[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        places = np.tile(np.arange(sums.shape[1], dtype=np.int32), 2)
        kinds = np.repeat(np.array([0, 1], dtype=np.int32), sums.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(places), pa.array(sums.ravel())], names=["label", "place", "value"])

    parts = statistics_rows.select("statistics", "label").mapInArrow(add_up, "label int, place int, value double")
    rows = parts.groupBy("label", "place").agg(F.sum("value").alias("value")).toPandas()  # 2 * (1 + d + d * d) rows
    total = np.zeros((2, 1 + d + d * d))
    total[rows["label"], rows["place"]] = rows["value"]
    return fitted(total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    return mapped(lambda texts: texts.map(statistics), batches)


def score_column(model: Discriminant, statistics_column: Column) -> Column:
    @F.pandas_udf("double")
    def score(rows):
        return pd.Series(model.score(np.array(rows.tolist(), dtype=float).reshape(len(rows), len(STATISTICS))))

    return score(statistics_column)


def _statistics_and_model(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str
) -> tuple[DataFrame, Discriminant]:
    """Rows of (own_id, statistics), written, and the model learnt from them."""
    rows = durable(
        docs.select(F.col(id_column).cast("long").alias("own_id"), statistics_of(F.col(text_column)).alias("statistics")),
        "quality-statistics",
    )
    known = training_labels(labels, "quality")
    model = fit(rows.join(known, rows["own_id"] == known["label_id"]).select("statistics", "label"))
    return rows, model


def score_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (higher: label 1 likelier) and predicted."""
    rows, model = _statistics_and_model(docs, labels, id_column, text_column)
    return rows.select(
        F.col("own_id").alias("doc_id"),
        (id_remainder(F.col("own_id"), HELD_OUT) == 0).alias("held_out"),
        score_column(model, F.col("statistics")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def with_good_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose predicted quality is 1. Statistics are taken once for the fit and once more for the decisions,
    each in place: leaving poor rows out by their ids would shuffle every text as soon as the ids are too many to broadcast."""
    rows, model = _statistics_and_model(docs, labels, "doc_id", "text")
    drop_durable(rows)
    return docs.where(score_column(model, statistics_of(F.col("text"))) >= THRESHOLD)
