"""Quality and toxicity: held-out accuracy, the models' parts, odd rows."""

import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from ledgerlane.llm import quality, toxicity
from ledgerlane.llm.quality import score_quality, with_good_quality
from ledgerlane.llm.toxicity import score_toxicity, without_toxic

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet"), spark.read.parquet(f"{TABLES}/labels.parquet")


def held_out(scored, labels, label):
    rows = scored.join(labels.select("doc_id", label), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    return np.array([[r[label], r.predicted, r.score] for r in rows])


def test_quality_of_held_out_documents(tables):
    docs, labels = tables
    scored = score_quality(docs, labels)
    assert scored.count() == docs.count()
    rows = held_out(scored, labels, "quality")
    assert (rows[:, 0] == rows[:, 1]).mean() >= 0.95
    kept = {r.doc_id for r in with_good_quality(docs, labels).collect()}
    assert kept == {r.doc_id for r in scored.where("predicted = 1").collect()}


def test_toxicity_of_held_out_documents(tables):
    docs, labels = tables
    scored = score_toxicity(docs, labels)
    assert scored.count() == docs.count()
    rows = held_out(scored, labels, "toxic")
    assert (rows[rows[:, 0] == 0][:, 1] == 0).mean() >= 0.98
    assert (rows[:, 0] == rows[:, 1]).mean() >= 0.9
    kept = {r.doc_id for r in without_toxic(docs, labels).collect()}
    assert kept == {r.doc_id for r in scored.where("predicted = 0").collect()}


def test_discriminant_equals_the_densities():
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    groups = [rng.normal(size=(400, d)), rng.normal(size=(900, d)) * 2 + 1]
    model = quality.fitted(
        np.array([400.0, 900.0]), np.array([g.sum(axis=0) for g in groups]), np.array([g.T @ g for g in groups])
    )
    pooled = sum(np.cov(g.T, bias=True) * len(g) for g in groups) / 1300
    logs = []
    for g in groups:
        own = (1 - quality.POOLED) * np.cov(g.T, bias=True) + quality.POOLED * pooled
        cov = (1 - quality.IDENTITY) * own + quality.IDENTITY * np.trace(own) / d * np.eye(d)
        x = groups[1][:50] - g.mean(axis=0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", x, np.linalg.inv(cov), x) - 0.5 * np.linalg.slogdet(cov)[1] + np.log(len(g) / 1300))
    assert np.allclose(model.score(groups[1][:50]), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_long_texts_have_the_same_statistics_in_blocks(monkeypatch):
    text = "Some words, some MORE words!! | and | the the end. " * 200
    want = quality.statistics(text)
    monkeypatch.setattr(quality, "BLOCK_CHARS", 90)
    assert np.allclose(quality.statistics(text), want)
    stems = {"word": 1}
    whole = toxicity.Counter(stems).counts(text + " you idiot! words")
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 100)
    assert toxicity.Counter(stems).counts(text + " you idiot! words")[:6] == whole[:6]


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(5)
    n = 20_000
    y = rng.random(n) < 0.3
    patterns = np.full((n, len(toxicity.VOTERS)), toxicity.ABSTAIN, dtype=np.int8)
    patterns[np.where(y, rng.random(n) < 0.6, rng.random(n) < 0.02), 0] = toxicity.TOXIC
    patterns[:, 1] = patterns[:, 0]  # says what the first says
    patterns[np.where(y, rng.random(n) < 0.5, rng.random(n) < 0.05), 2] = toxicity.TOXIC
    patterns[np.where(y, rng.random(n) < 0.1, rng.random(n) < 0.9), 9] = toxicity.CLEAN
    known, wrong = rng.random(n) < 0.3, rng.random(n) < 0.05
    labels = np.where(known, (y ^ wrong).astype(int), -1)
    patterns[:, 10] = np.select([labels == 1, labels == 0], [toxicity.TOXIC, toxicity.CLEAN], toxicity.ABSTAIN)
    model = toxicity.fit_label_model(patterns, np.ones(n))
    assert np.allclose([model.chances[10, 1, toxicity.TOXIC], model.chances[10, 0, toxicity.CLEAN]], 0.3 * 0.95, atol=0.03)
    assert np.allclose(model.chances[[0, 2], 1, toxicity.TOXIC], [0.6, 0.5], atol=0.05)
    assert np.allclose(model.chances[[0, 2], 0, toxicity.TOXIC], [0.02, 0.05], atol=0.02)
    assert model.correlations[0, 1] > 0.95 and abs(model.correlations[0, 2]) < 0.15
    assert model.weights[0] < 0.65 < model.weights[2]
    assert ((model.posterior(patterns) > 0.5) == y).mean() > 0.85


def plain_label_model(patterns):
    """The label model row by row and voter by voter."""
    voters = len(toxicity.VOTERS)
    chances = [[[(a + 0.02) / (sum(of) + 0.06) for a in of] for of in voter] for voter in toxicity.ASSUMED.tolist()]
    start, weights, prior = [[list(of) for of in voter] for voter in chances], [1.0] * voters, 0.1

    def posterior(row):
        ratio = math.log(prior) - math.log(1 - prior)
        ratio += sum(w * (math.log(c[1][v]) - math.log(c[0][v])) for w, c, v in zip(weights, chances, row))
        return 1 / (1 + math.exp(-ratio))

    for _ in range(toxicity.EM_ROUNDS):
        toxic = [posterior(row) for row in patterns]
        chances = [[[4 * x for x in of] for of in voter] for voter in start]
        for row, t in zip(patterns, toxic):
            for j, vote in enumerate(row):
                chances[j][1][vote] += t
                chances[j][0][vote] += 1 - t
        chances = [[[x / sum(of) for x in of] for of in voter] for voter in chances]
        said = [[(v == toxicity.TOXIC) - (v == toxicity.CLEAN) for v in row] for row in patterns]
        cov = [[0.0] * voters for _ in range(voters)]
        for share in ([1 - t for t in toxic], toxic):
            total = sum(share)
            mean = [sum(s * row[j] for s, row in zip(share, said)) / total for j in range(voters)]
            for i in range(voters):
                for j in range(voters):
                    cov[i][j] += sum(s * (row[i] - mean[i]) * (row[j] - mean[j]) for s, row in zip(share, said))
        scale = [math.sqrt(max(cov[j][j], 1e-9)) for j in range(voters)]
        weights = [1 / sum(1 if i == j else abs(cov[i][j] / scale[i] / scale[j]) for i in range(voters)) for j in range(voters)]
        prior = min(max((sum(toxic) + 1) / (len(patterns) + 10), 1e-4), 1 - 1e-4)
    return [posterior(row) for row in patterns]


def test_toxicity_against_a_plain_version(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(160):
        words = rng.choice(["plain", "words", "about", "weather", "nothing"], 12).tolist()
        if k % 4 == 0:
            words[:3] = rng.choice(["grumbletop", "idiot", "stupid", "grumbletops", "you moron"], 3).tolist()
        rows.append((k, " ".join(words) + ("!!" if k % 8 == 0 else "")))
    known = {k: int(k % 4 == 0) for k in range(0, 160, 2)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, v) for k, v in known.items()], "doc_id long, toxic int")
    scored = {r.doc_id: r.score for r in score_toxicity(docs, labels).collect()}

    fold = {k: zlib.crc32(str(k).encode()) % 5 for k in range(160)}
    learnable = {k: v for k, v in known.items() if fold[k]}
    stems = {}
    for length in toxicity.STEM_LENGTHS:
        holders = {}
        for k, v in learnable.items():
            for stem in {w[:length] for w in re.findall(r"[^\W\d_]+", rows[k][1].lower()) if len(w) >= length}:
                holders.setdefault(stem, []).append(v)
        n_toxic = sum(learnable.values())
        for stem, of in holders.items():
            if sum(of) >= max(toxicity.STEM_DOCUMENTS, toxicity.STEM_SHARE * n_toxic) and sum(of) >= toxicity.STEM_PRECISION * len(of):
                stems[stem] = xxhash.xxh64_intdigest(stem) % 2
    assert any(stem.startswith("grum") for stem in stems)
    counter = toxicity.Counter(stems)
    training = [k for k in range(160) if fold[k]]
    counts = np.array([counter.counts(rows[k][1]) for k in range(160)])
    patterns = toxicity.votes(counts, np.array([learnable.get(k, -1) for k in range(160)]))[training].tolist()
    target, x = np.array(plain_label_model(patterns)), toxicity.features(counts)
    weights = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-x[training] @ weights))
        hessian = (x[training] * (p * (1 - p))[:, None]).T @ x[training] + toxicity.RIDGE * np.eye(len(weights))
        weights += np.linalg.solve(hessian, x[training].T @ (target - p) - toxicity.RIDGE * weights)
    want = 1 / (1 + np.exp(-x @ weights))
    assert np.allclose([scored[k] for k in range(160)], want, atol=1e-3)
    assert all((scored[k] >= 0.5) == (k % 4 == 0) for k in range(160))


def test_quality_against_a_plain_fit(spark, tables):
    docs, labels = tables
    scored = {r.doc_id: r.score for r in score_quality(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    learnable = [(r.doc_id, r.quality) for r in labels.collect() if r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 5]
    groups = [np.array([quality.statistics(texts[k]) for k, label in learnable if label == of]) for of in (0, 1)]
    model = quality.fitted(
        np.array([float(len(g)) for g in groups]), np.array([g.sum(axis=0) for g in groups]), np.array([g.T @ g for g in groups])
    )
    some = sorted(texts)[::7]
    assert np.allclose([scored[k] for k in some], model.score(np.array([quality.statistics(texts[k]) for k in some])), atol=1e-6)


@pytest.mark.parametrize(("score", "keep", "label"), [(score_quality, with_good_quality, "quality"), (score_toxicity, without_toxic, "toxic")])
def test_nulls_repeats_missing_labels_and_empty_tables(spark, score, keep, label):
    docs = spark.createDataFrame(
        [(1, None, "a", 1), (None, "", "a", 1), (2, "plain words", "a", 1), (2, "plain words", "a", 1), (3, "x" * 3000, "a", 1)],
        "doc_id long, text string, own_id string, label int",
    )
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, None, None), (2, 0, 1), (2, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"
    )
    kept_class = 1 if label == "quality" else 0
    for known in (labels, labels.limit(0)):
        rows = score(docs, known).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert keep(docs, known).columns == docs.columns
        assert keep(docs, known).count() == sum(r.predicted == kept_class for r in rows)
    assert score(docs.limit(0), labels).count() == 0
    assert keep(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize(("score", "keep", "label"), [(score_quality, with_good_quality, "quality"), (score_toxicity, without_toxic, "toxic")])
def test_rows_without_an_id_and_rows_of_one_id_are_decided_by_their_text(spark, tables, score, keep, label):
    docs, labels = tables
    wanted = 1 if label == "quality" else 0
    ids = {p: [r.doc_id for r in score(docs, labels).where(f"predicted = {p}").limit(2).collect()] for p in (0, 1)}
    texts = {p: [r.text for r in docs.where(docs.doc_id.isin(ids[p])).collect()] for p in (0, 1)}
    rows = [(doc_id, t, "kept" if p == wanted else "gone") for p in (0, 1) for t in texts[p] for doc_id in (None, None, -5)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, gone_key string")
    both = docs.select("doc_id", "text").withColumn("gone_key", F.lit("other")).union(odd)
    found = [r for r in keep(both, labels).collect() if r.gone_key != "other"]
    assert len(rows) == 12
    assert sorted((str(r.doc_id), r.text, r.gone_key) for r in found) == sorted((str(d), t, k) for d, t, k in rows if k == "kept")


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for score, keep in ((score_quality, with_good_quality), (score_toxicity, without_toxic)):
        assert score(docs, labels).count() == 0 and keep(docs, labels).count() == 0


@pytest.mark.parametrize("score", [score_quality, score_toxicity])
def test_ids_that_are_no_numbers_are_refused(spark, score):
    docs = spark.createDataFrame([("a-1", "some words")], "doc_id string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    with pytest.raises(NumberFormatException):
        score(docs, labels).collect()


@pytest.mark.parametrize("keep", [with_good_quality, without_toxic])
def test_texts_are_left_out_without_a_shuffle(spark, tables, keep):
    docs, labels = tables
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keep(docs, labels)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange" not in plan and "Join" not in plan
