"""The audit against SQL, the matrix against plain counting, and a brute-force version on odd rows."""

import itertools
import re
from collections import Counter

from compare import connect, differences

from ledgerlane.llm import audit
from ledgerlane.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, shard int, fails string"


def documents(spark, rows):
    """With columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*row, 7, "x") for row in rows], DOCS)


def label_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute_force(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs),
        }
        failed.append((lang or "", {f for f, v in fails.items() if v}, doc_id in good, doc_id in toxic))
    orders, found = ["".join(p) for p in itertools.permutations("ABCDE")], {}
    for part in {row[0] for row in failed}:
        own = [row[1:] for row in failed if row[0] == part]
        shares = {f: sum(next((x for x in o if x in s), None) == f for o in orders for s, *_ in own) for f in "ABCDE"}
        for order in orders:
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [row for row in own if f in row[0] and not row[0] & before]
                found[part, order, step] = (
                    sum(not row[0] & (before | {f}) for row in own), len(here),
                    sum(f in row[0] and bool(row[0] & before) for row in own), sum(row[0] == {f} for row in own),
                    sum(row[1] for row in here), sum(row[2] for row in here), shares[f],
                )
    return found


def as_dict(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in df.collect()}


def test_query_equals_the_statement(spark, data):
    assert differences(QUERIES["op11_filter_audit"](spark, data), connect(data), audit.ORACLE_SQL) == []


def test_odd_rows(spark):
    long_text = "Word " * 250 + "$"
    varied = " ".join(f"w{k}" for k in range(300))
    docs = [
        (1, None, None), (2, "", "en"), (3, "", ""), (None, "", "en"), (None, long_text, "en"), (5, long_text, "en"),
        (5, long_text, "fr"), (6, long_text, "fr"), (7, varied, "en"), (8, varied.upper(), "en"), (9, " \t\n", "en"),
        (10, varied + "\x00é|", None), (10, "a\x0bb", "en"), (-4, varied, "fr"),
    ]
    labels = [(5, 1, 0), (5, 0, 1), (6, 0, 1), (7, 1, None), (7, 1, 0), (None, 1, 1), (2, None, None)]
    got = as_dict(audit.filter_audit(documents(spark, docs), label_rows(spark, labels)))
    assert got == brute_force(docs, labels)


def test_many_small_shards_and_the_matrix(spark, data, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    whole = as_dict(audit.filter_audit(docs, spark.read.parquet(f"{data}/labels.parquet")))
    texts = {r.doc_id: Counter((r.text or "").encode().split()) for r in docs.collect()}
    cells = audit.sparse_rows(docs)
    places = audit.word_places(cells)
    words = {r.number: bytes(r.word) for r in audit.dictionary(places).collect()}
    assert set(words) == set(range(len(words))) and sorted(words.values()) == sorted(set().union(*texts.values()))
    seen = {}
    for shard in audit.csr_shards(cells, places).collect():
        for k, doc_id in enumerate(shard.doc_ids):
            own = slice(shard.borders[k], shard.borders[k + 1])
            seen[doc_id] = {words[c]: n for c, n in zip(shard.columns[own], shard.counts[own])}
    assert seen == texts

    source = audit._cells.__globals__
    monkeypatch.setitem(source, "SHARD_ENTRIES", 500)
    small = spark.read.parquet(f"{data}/documents.parquet").repartition(3)
    assert as_dict(audit.filter_audit(small, spark.read.parquet(f"{data}/labels.parquet"))) == whole


def test_empty_tables(spark):
    none = documents(spark, [])
    assert audit.filter_audit(none, label_rows(spark, [])).count() == 0
    only_empty = as_dict(audit.filter_audit(documents(spark, [(1, "", None), (2, None, None)]), label_rows(spark, [])))
    assert only_empty == brute_force([(1, "", None), (2, None, None)], [])
