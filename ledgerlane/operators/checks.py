"""Data-quality checks. Every check is a query for violating rows; none means it passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.groups import dealt


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once; null is not a key."""
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    return df.where(present).groupBy(*columns).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(~F.col(column).isin(list(values)))


def accepted_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys without a parent and how many rows carry each.

    Keys are counted before the join, so a missing key shared by very many rows stays one row.
    """
    keys = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("missing_key"))
        .agg(F.count("*").alias("rows_affected"))
    )
    known = parent.select(F.col(parent_column).alias("missing_key"))
    return keys.join(known, "missing_key", "left_anti")


@dataclass(frozen=True)
class Check:
    """A named violation query. ``weight`` is a column to sum where a violation stands for many rows."""

    name: str
    severity: str
    violations: DataFrame
    weight: str | None = None

    def outcome(self) -> DataFrame:
        counted = F.count("*") if self.weight is None else F.coalesce(F.sum(self.weight), F.lit(0))
        return _report(self.violations.agg(counted.alias("failures")), self.name, self.severity)


def _report(failures: DataFrame, name: str, severity: str) -> DataFrame:
    return failures.select(
        F.lit(name).alias("test"), F.lit(severity).alias("severity"), F.col("failures").cast("bigint")
    )


def with_status(outcomes: DataFrame) -> DataFrame:
    return outcomes.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")))


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """One row per check: test, severity, failures, status."""
    return with_status(reduce(DataFrame.unionByName, [check.outcome() for check in checks]))


@dataclass(frozen=True)
class ModelTests:
    """Column tests of one model: names to test, allowed values, and inclusive ranges. A ``large`` model is dealt out
    by its first unique column."""

    model: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted_values: dict[str, Sequence[str]] | None = None
    accepted_range: dict[str, tuple[float, float]] | None = None
    severity: str = "error"
    large: bool = False

    def row_conditions(self) -> dict[str, Column]:
        """Test name to the condition a violating row meets."""
        conditions = {f"not_null:{self.model}.{c}": F.col(c).isNull() for c in self.not_null}
        for column, values in (self.accepted_values or {}).items():
            conditions[f"accepted_values:{self.model}.{column}"] = ~F.col(column).isin(list(values))
        for column, (low, high) in (self.accepted_range or {}).items():
            conditions[f"accepted_range:{self.model}.{column}"] = ~F.col(column).between(low, high)
        return conditions


def is_staged(model: str) -> bool:
    """Whether a model comes before the marts: a raw feed or a staged one."""
    return model.startswith(("raw_", "stg_"))


def run_model_tests(df: DataFrame, tests: ModelTests) -> DataFrame:
    """All tests of a model in as few passes as there are unique columns (at least one).

    Row tests are counted per key of the first unique column, and the repeated keys among those
    groups are that column's own test.
    """
    row_tests = tests.row_conditions()
    counts = {f"_{i}": F.count_if(condition) for i, condition in enumerate(row_tests.values())}
    passes = []
    if tests.unique:
        first, *others = tests.unique
        parts = dealt(df, first) if tests.large else [df]
        per_key = reduce(
            DataFrame.unionByName,
            [part.groupBy(first).agg(F.count("*").alias("_n"), *[c.alias(k) for k, c in counts.items()]) for part in parts],
        )
        repeated = F.count_if(F.col(first).isNotNull() & (F.col("_n") > 1))
        totals = per_key.agg(
            repeated.alias("_unique"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in counts]
        )
        names = {f"unique:{tests.model}.{first}": "_unique"}
        passes += [
            Check(f"unique:{tests.model}.{column}", tests.severity, unique(df, column)).outcome()
            for column in others
        ]
    else:
        totals = df.agg(*[c.alias(k) for k, c in counts.items()])
        names = {}
    names.update(zip(row_tests, counts))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("test"),
                F.lit(tests.severity).alias("severity"),
                F.col(column).cast("bigint").alias("failures"),
            )
            for name, column in names.items()
        ]
    )
    return reduce(DataFrame.unionByName, [totals.select(F.inline(rows)), *passes])
