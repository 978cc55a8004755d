"""The corpus pipeline: stages that filter documents one after the other, and at last encode them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlane.functions.durable import drop_durable, durable
from ledgerlane.llm.decontaminate import without_contaminated
from ledgerlane.llm.pieces import encode_documents
from ledgerlane.llm.quality import with_good_quality
from ledgerlane.llm.simhash import without_near_duplicates
from ledgerlane.llm.tables import read_table
from ledgerlane.llm.toxicity import without_toxic

#: Trained models and seeded hashes have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return without_toxic(docs, read_table(spark, folder, "labels"))


def quality_classifier(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return with_good_quality(docs, read_table(spark, folder, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return without_contaminated(docs, read_table(spark, folder, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again by the next."""
    docs, written = read_table(spark, folder, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, folder), f"pipeline-{name}")
        if written is not None:
            drop_durable(written)
        written = docs
    return STAGES[-1][1](spark, docs, folder)
