"""What Python workers keep of the texts that they have seen."""

import pandas as pd
import pyarrow as pa
import pytest

from ledgerlane.llm import decontaminate, memory, pieces, quality, simhash
from ledgerlane.llm.quality import statistics


def test_memory_is_given_back_after_every_batch_and_at_the_end(monkeypatch):
    given = []
    monkeypatch.setattr(memory, "give_back", lambda: given.append(True))
    batches = [pd.Series(["a b", None]), pd.Series(["", "c"]), pd.Series([], dtype=object)]
    found = list(memory.mapped(lambda texts: texts.map(statistics), iter(batches)))
    assert [list(f) for f in found] == [[statistics(t) for t in b] for b in batches]
    assert len(given) == 4


def test_arrow_keeps_nothing_afterwards():
    kept = pa.array(["x" * 1000] * 10_000)
    del kept
    memory.give_back()
    assert pa.total_allocated_bytes() < 1 << 20


@pytest.mark.parametrize("function", [quality.statistics_of.func, simhash.fingerprint_column, decontaminate._seeded_regions, pieces.encode_documents])
def test_the_functions_over_whole_texts_give_memory_back(function):
    def names(code):
        return set(code.co_names) | set(code.co_freevars).union(*[names(c) for c in code.co_consts if hasattr(c, "co_names")])

    assert names(function.__code__) & {"give_back", "mapped"}


def test_skips_do_not_depend_on_how_many_occurrences_are_looked_at_together(monkeypatch):
    texts = ["the cat sat on the mat " * 9, "", "the dog, the cat and the end. " * 7] * 4
    whole = pieces.Encoder(pieces.load()).encode(texts, range(12))
    monkeypatch.setattr(pieces, "OCCURRENCES_AT_ONCE", 3)
    sliced = pieces.Encoder(pieces.load()).encode(texts, range(12))
    assert [list(a) for a in whole] == [list(b) for b in sliced]
