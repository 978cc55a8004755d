"""Setting aside the rows that break a rule, with the rules they break.

All row rules of a table are looked at in one pass: each is a bit of one number per row. A rule may
also ask for a partner in another table, which is one left join on distinct keys. A table that is
written anyway is split by that number in the same write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROKEN = "broken_rules"
SET_ASIDE = "set_aside"


@dataclass(frozen=True)
class Partner:
    """A row that meets ``when`` and whose ``column`` is not null needs a row of ``table`` with that ``key``."""

    column: str
    table: DataFrame
    key: str
    when: Column | None = None


@dataclass(frozen=True)
class RowRules:
    """Rules of one model's rows: name to the condition that a violating row meets, and name to a needed partner."""

    model: str
    key: str
    conditions: dict[str, Column] = field(default_factory=dict)
    partners: dict[str, Partner] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [*self.conditions, *self.partners]

    def __post_init__(self) -> None:
        if len(self.names) > 63:
            raise ValueError(f"{self.model} has more rules than a number has bits")


def with_broken_rules(df: DataFrame, rules: RowRules) -> DataFrame:
    """The rows with ``broken_rules``: bit k is set when the k-th rule is broken. A condition that is null is met by nobody."""
    conditions = dict(rules.conditions)
    columns = df.columns
    for number, (name, partner) in enumerate(rules.partners.items()):
        known, key = f"_known_{number}", f"_key_{number}"
        keys = partner.table.select(F.col(partner.key).alias(key)).where(F.col(key).isNotNull()).distinct()
        df = df.join(keys.withColumn(known, F.lit(True)), F.col(partner.column) == F.col(key), "left")
        asked = F.col(partner.column).isNotNull() if partner.when is None else F.col(partner.column).isNotNull() & partner.when
        conditions[name] = asked & F.col(known).isNull()
    bits = [F.when(condition, F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, condition in enumerate(conditions.values())]
    return df.withColumn(BROKEN, reduce(Column.__add__, bits)).select(*columns, BROKEN)


def _broken(k: int) -> Column:
    return F.col(BROKEN).bitwiseAND(1 << k) != 0


def rule_names(names: Sequence[str]) -> Column:
    """The names of a row's broken rules."""
    return F.filter(F.array(*[F.when(_broken(k), F.lit(name)) for k, name in enumerate(names)]), lambda name: name.isNotNull())


def _observed(df: DataFrame, rules: RowRules) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *[F.count_if(_broken(k)).alias(f"r{k}") for k in range(len(rules.names))]), seen


def _counts(seen: Observation, written: DataFrame, rules: RowRules) -> dict[str, int]:
    """Violations per rule as the write saw them. A task that ran again may have been counted twice, never less than
    once, so where the write saw any, the rows that were set aside are counted."""
    found = dict(zip(rules.names, (seen.get[f"r{k}"] for k in range(len(rules.names)))))
    if not any(found.values()):
        return found
    row = written.agg(*[F.count_if(_broken(k)).alias(f"r{k}") for k in range(len(rules.names))]).first()
    return dict(zip(rules.names, row))


def write_split(df: DataFrame, rules: RowRules, path: str) -> dict[str, int]:
    """Write a table once, sound rows and rows set aside in folders of their own, and return the violations per rule.
    Read the parts with ``sound_rows`` and ``set_aside_rows``."""
    marked, seen = _observed(with_broken_rules(df, rules), rules)
    marked.withColumn(SET_ASIDE, F.col(BROKEN) != 0).write.partitionBy(SET_ASIDE).parquet(path)
    return _counts(seen, _part(df, path).where(SET_ASIDE), rules)


def _part(df: DataFrame, path: str) -> DataFrame:
    added = [T.StructField(BROKEN, T.LongType()), T.StructField(SET_ASIDE, T.BooleanType())]
    return df.sparkSession.read.schema(T.StructType([*df.schema.fields, *added])).parquet(path)


def sound_rows(df: DataFrame, path: str) -> DataFrame:
    """The rows of a split table that break no rule; ``df`` gives the columns."""
    return _part(df, path).where(~F.col(SET_ASIDE)).select(df.columns)


def set_aside_rows(df: DataFrame, rules: RowRules, path: str) -> DataFrame:
    """The rows that break a rule, with the names of the rules."""
    return _part(df, path).where(SET_ASIDE).withColumn("rules", rule_names(rules.names)).select(*df.columns, "rules")


def write_broken(df: DataFrame, rules: RowRules, path: str) -> dict[str, int]:
    """Write only the rows of a view that break a rule, with the rules' names; violations per rule come from the same pass."""
    marked, seen = _observed(with_broken_rules(df, rules), rules)
    marked.where(F.col(BROKEN) != 0).withColumn("rules", rule_names(rules.names)).write.parquet(path)
    return _counts(seen, df.sparkSession.read.parquet(path), rules)


def broken_rows(df: DataFrame, rules: RowRules) -> DataFrame:
    """(model, row_key, rules): one row per row that breaks any rule; rules by name, joined with commas."""
    broken = with_broken_rules(df, rules).where(F.col(BROKEN) != 0)
    return broken.select(
        F.lit(rules.model).alias("model"),
        F.col(rules.key).cast("string").alias("row_key"),
        F.array_join(F.array_sort(rule_names(rules.names)), ",").alias("rules"),
    )


def all_broken_rows(tables: Sequence[tuple[DataFrame, RowRules]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [broken_rows(df, rules) for df, rules in tables])
