"""Every registered query returns exactly what its DuckDB statement returns, by a sound plan."""

import pytest
from compare import differences
from pyspark.sql.readwriter import DataFrameWriter

from duck_oracle import STATEMENTS
from ledgerlane.plans.registry import QUERIES

# All-pairs joins, Python per row, and collecting a side without a proven bound have no place here.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.fixture
def written(monkeypatch):
    """The plans of the tables that are written while a query is built."""
    plans, write = [], DataFrameWriter.parquet

    def recording(writer, *args, **options):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", recording)
    return plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, written, name):
    result = QUERIES[name](spark, data)
    plans = [*written, result._jdf.queryExecution().executedPlan().toString()]
    assert not [node for node in FORBIDDEN if any(node in plan for plan in plans)]
    assert differences(result, duck, STATEMENTS[name]) == []
