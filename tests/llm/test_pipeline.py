"""Every stage keeps what its operator decides, and the whole equals its stages."""

import corpus_pipeline
import pytest

from ledgerlane.llm.queries import ORACLE_SQL, QUERIES
from ledgerlane.llm.quality import score_quality
from ledgerlane.llm.simhash import near_duplicates
from ledgerlane.llm.toxicity import score_toxicity

FOLDER = "/root/testdata/sf0.01"


def test_names():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE_SQL) < set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality_classifier", "simhash_dedup", "decontamination", "sentencepiece"
    ]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before the first stage and after each."""
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        found.append(docs)
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*found, docs]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    start, mild, good, single, clean, encoded = stages
    assert all(df.columns == start.columns for df in stages[:-1])
    assert ids(mild) == ids(score_toxicity(start, labels).where("predicted = 0"))
    assert ids(good) == ids(score_quality(mild, labels).where("predicted = 1"))
    assert ids(single) == ids(near_duplicates(good).where("doc_id = component_id"))
    assert 0 < single.count() - clean.count() < 40
    assert ids(encoded) == ids(clean) and encoded.where("lossless").count() == clean.count()
    assert set(start.columns) < set(encoded.columns)


def test_run_equals_the_stages(spark, stages):
    rows = lambda df: sorted((r.doc_id, r.n_pieces, tuple(r.piece_ids)) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, FOLDER)) == rows(stages[-1])
