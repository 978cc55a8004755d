"""Build, check and publish: all marts replace the published ones at once, and only when no error check fails.

``out_dir`` holds one folder per run and a pointer file that names the current one; read the marts in
``published(spark, out_dir)``. A run passes three gates: its sources are fresh, its staging is sound, its
marts are sound. Every gate that stops it leaves the rows that broke a rule under ``stopped``. The last
runs stay, so a reader that has resolved the pointer keeps its files; older ones go by age.

Every run leaves, under ``history``, the rows of each mart that the run before did not have, had otherwise
or had in addition; ``mart_versions`` reads them as versions with validity ranges, whatever runs are left.

Layers that were written before a run stopped are kept under a name made of their input files, and the
next run over the same files takes them up instead of writing them again.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.columns import present
from ledgerlane.functions.durable import drop_durable, durable
from ledgerlane.functions.files import children, delete, filesystem
from ledgerlane.operators.checks import run_checks
from ledgerlane.operators.freshness import freshness
from ledgerlane.operators.history import differences, versions
from ledgerlane.operators.quarantine import RowRules, write_broken
from ledgerlane.plans import ride_checks, workforce_checks
from ledgerlane.plans.ride import RideModels
from ledgerlane.plans.workforce import DEFAULT_AS_OF, WorkforceModels
from ledgerlane.sources.tables import RideTables, WorkforceTables


class BlockedByChecks(RuntimeError):
    """An error check failed; nothing was published. ``failed`` holds the report rows."""

    def __init__(self, failed: list[Row]):
        super().__init__("failed checks: " + ", ".join(row.test for row in failed))
        self.failed = failed


class StaleSources(RuntimeError):
    """A source is too old; nothing was built. ``stale`` holds the report rows."""

    def __init__(self, stale: list[Row]):
        super().__init__("stale sources: " + ", ".join(row.source for row in stale))
        self.stale = stale


@dataclass(frozen=True)
class Keeping:
    """How many finished runs stay whatever their age, and how long older ones stay for their readers."""

    runs: int = 2
    age: timedelta = timedelta(days=2)


POINTER = "CURRENT"

#: What makes a row of a mart the same row in another run; a mart of one row has no key.
RIDE_KEYS = {"mart_drivers": ["driver_id"], "mart_riders": ["rider_id"], "mart_marketplace_kpis": ["report_month"]}
WORKFORCE_KEYS = {"dim_department": ["department_id"], "fct_workforce": ["person_id"], "fct_attrition_monthly": ["month_start"]}


def published(spark: SparkSession, out_dir: str) -> str | None:
    """The folder of the marts published last, or None."""
    files, pointer = filesystem(spark, f"{out_dir}/{POINTER}")
    if not files.exists(pointer):
        return None
    return f"{out_dir}/{spark.read.text(f'{out_dir}/{POINTER}').first()[0]}"


def _switch(spark: SparkSession, out_dir: str, run: str) -> None:
    """Point to another run. The pointer is written beside the old one and renamed over it in one step."""
    files, fresh = filesystem(spark, f"{out_dir}/{POINTER}-{run}")
    stream = files.create(fresh, True)
    stream.write(bytearray(run.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context.rename(fresh, filesystem(spark, f"{out_dir}/{POINTER}")[1], options)


def _sweep(spark: SparkSession, out_dir: str, keeping: Keeping) -> None:
    """Delete finished runs beyond the last ones, once they are old enough that nobody reads them."""
    runs = {name: changed for name, changed in children(spark, out_dir).items() if name.startswith("run-")}
    newest = sorted(runs, key=runs.get, reverse=True)
    for name in newest[keeping.runs :]:
        if time.time() - runs[name] > keeping.age.total_seconds():
            delete(spark, f"{out_dir}/{name}")


def _fingerprint(tables: Sequence[DataFrame], *parameters: object) -> str | None:
    """Names, sizes and times of all input files, and the parameters, as one name; None where a table has no files."""
    found = hashlib.sha256(repr(parameters).encode())
    for table in tables:
        paths = sorted(table.inputFiles())
        if not paths:
            return None
        for path in paths:
            files, target = filesystem(table.sparkSession, path)
            status = files.getFileStatus(target)
            found.update(f"{path} {status.getLen()} {status.getModificationTime()}\n".encode())
        found.update(b";")
    return found.hexdigest()[:32]


def _settle_layer(models: RideModels | WorkforceModels, names: Sequence[str], folder: str | None) -> list[str]:
    """Write models and use the written copies from now on; those that an earlier run finished are taken as they are.
    Returns the names that were written."""
    written = []
    for name in names:
        model = getattr(models, name)
        if folder is None:
            models.settle([name])
            written.append(name)
            continue
        path, spark = f"{folder}/{name}", model.sparkSession
        if "_SUCCESS" not in children(spark, path):
            model.write.mode("overwrite").parquet(path)
            written.append(name)
        models.__dict__[name] = spark.read.schema(model.schema).parquet(path)
    return written


def _failed(report: DataFrame) -> tuple[list[Row], list[Row]]:
    """One row per check, so the driver holds a few dozen rows; the rows, and those of failed error checks."""
    outcomes = report.orderBy("test").collect()
    return outcomes, [row for row in outcomes if row.status == "error"]


def _set_aside(tables: Sequence[tuple[DataFrame, RowRules]], path: str) -> dict[str, int]:
    """Write the rows that break a row rule, a folder per model, and return the violations per rule. Models without
    a violation leave no folder."""
    found: dict[str, int] = {}
    for df, rules in tables:
        if rules.names:
            counts = write_broken(df, rules, f"{path}/{rules.model}")
            if not any(counts.values()):
                delete(df.sparkSession, f"{path}/{rules.model}")
            found |= counts
    return found


def _write_changes(spark: SparkSession, keys: dict[str, list[str]], before: str | None, run: str) -> None:
    """The differences to the run before, per mart, within the run's own folder."""
    moment = F.lit(datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    for mart, own in keys.items():
        after = spark.read.parquet(f"{run}/{mart}")
        old = spark.read.schema(after.schema).parquet(f"{before}/{mart}") if before else after.limit(0)
        changes = differences(old, after, own).withColumn("run_at", moment)
        changes.write.parquet(f"{run}/changes/{mart}")


def _file_changes(spark: SparkSession, keys: dict[str, list[str]], out_dir: str, run: str) -> None:
    """Move a published run's differences to where they outlive the run."""
    for mart in keys:
        files, source = filesystem(spark, f"{out_dir}/{run}/changes/{mart}")
        target = filesystem(spark, f"{out_dir}/history/{mart}/{run}")[1]
        files.mkdirs(target.getParent())
        files.rename(source, target)


def mart_versions(spark: SparkSession, out_dir: str, mart: str, keys: Sequence[str]) -> DataFrame:
    """All versions of a mart's rows over all runs so far, with valid_from and valid_to."""
    folder = f"{out_dir}/history/{mart}"
    return versions(spark.read.parquet(*(f"{folder}/{run}" for run in children(spark, folder))), keys)


@dataclass
class _Run:
    """What a domain brings to the gates: models, staging layer, reports and row rules."""

    models: RideModels | WorkforceModels
    staging: Sequence[str]
    facts: Sequence[str]
    staging_report: Callable[[], DataFrame]
    mart_report: Callable[[], DataFrame]
    row_rules: Callable[[], list[tuple[DataFrame, RowRules]]]
    sources: dict[str, tuple[DataFrame, str]]
    fingerprint: str | None
    mart_keys: dict[str, list[str]]


def _gate(run: _Run, report: DataFrame, out_dir: str, staged_only: bool) -> list[Row]:
    """The outcomes, or ``BlockedByChecks`` after setting aside what broke a rule."""
    outcomes, failed = _failed(report)
    if failed:
        rules = run.row_rules()
        if staged_only:
            rules = [(df, own) for df, own in rules if own.model.startswith(("raw_", "stg_"))]
        _set_aside(rules, f"{out_dir}/stopped/{uuid.uuid4().hex}/set_aside")
        raise BlockedByChecks(failed)
    return outcomes


def _publish(run: _Run, out_dir: str, fresh_at: datetime | None, keeping: Keeping) -> list[Row]:
    models = run.models
    spark = next(iter(run.sources.values()))[0].sparkSession
    if fresh_at is not None:
        stale = [row for row in freshness(run.sources, fresh_at).collect() if row.status == "error"]
        if stale:
            raise StaleSources(stale)
    layer = f"{out_dir}/layers/{run.fingerprint}" if run.fingerprint else None
    _settle_layer(models, run.staging, layer)
    outcomes = _gate(run, run.staging_report(), out_dir, staged_only=True)
    _settle_layer(models, [*run.facts, *models.marts()], layer)
    report = durable(run.mart_report(), "checks")
    try:
        outcomes += _gate(run, report, out_dir, staged_only=False)
    finally:
        drop_durable(report)
    name = f"run-{uuid.uuid4().hex}"
    try:
        for mart, df in models.marts().items():
            present(df).write.parquet(f"{out_dir}/{name}/{mart}")
        _set_aside(run.row_rules(), f"{out_dir}/{name}/set_aside")
        _write_changes(spark, run.mart_keys, published(spark, out_dir), f"{out_dir}/{name}")
        outcomes.sort(key=lambda row: row.test)
        spark.createDataFrame(outcomes).coalesce(1).write.parquet(f"{out_dir}/{name}/check_report")
        _switch(spark, out_dir, name)
        _file_changes(spark, run.mart_keys, out_dir, name)
    except BaseException:
        delete(spark, f"{out_dir}/{name}")
        raise
    delete(spark, f"{out_dir}/layers")
    _sweep(spark, out_dir, keeping)
    return outcomes


def ride_sources(raw: RideTables) -> dict[str, tuple[DataFrame, str]]:
    """Tables and the column that says when a row came."""
    return {
        "raw_riders": (raw.riders, "signup_at"),
        "raw_drivers": (raw.drivers, "onboarded_at"),
        "raw_trips": (raw.trips, "requested_at"),
        "raw_payments": (raw.payments, "attempted_at"),
        "raw_driver_incentives": (raw.driver_incentives, "earned_at"),
    }


def workforce_sources(raw: WorkforceTables) -> dict[str, tuple[DataFrame, str]]:
    return {
        "raw_employees": (raw.employees, "hire_date"),
        "raw_performance_reviews": (raw.performance_reviews, "review_date"),
        "raw_payroll": (raw.payroll, "paid_at"),
    }


def publish_ride(
    raw: RideTables, out_dir: str, now: datetime = ride_checks.DEFAULT_NOW, fresh_at: datetime | None = None,
    keeping: Keeping = Keeping(),
) -> list[Row]:
    """Rebuild the ride-hailing marts under ``out_dir`` and return the check report.

    The checks read the written candidates, so what was checked is what gets published. Running
    again on the same feeds writes the same marts. With ``fresh_at`` the run stops when a source is
    older than the limits of ``freshness`` at that time.
    """
    models = RideModels(raw)
    sources = ride_sources(raw)

    def rules(names: set[str]) -> DataFrame:
        return run_checks([rule(models, now) for name, rule in ride_checks.RULES.items() if name in names])

    early = set(ride_checks.STAGING_RULES)
    run = _Run(
        models,
        ["stg_drivers", "stg_payments"],
        ["int_trips_enriched"],
        lambda: ride_checks.schema_test_report(models, staged=True).unionByName(rules(early)),
        lambda: ride_checks.schema_test_report(models, staged=False).unionByName(rules(set(ride_checks.RULES) - early)),
        lambda: ride_checks.row_rules(models, now),
        sources,
        _fingerprint([table for table, _ in sources.values()], "ride", now),
        RIDE_KEYS,
    )
    return _publish(run, out_dir, fresh_at, keeping)


def publish_workforce(
    raw: WorkforceTables, out_dir: str, as_of: date = DEFAULT_AS_OF, fresh_at: datetime | None = None,
    keeping: Keeping = Keeping(),
) -> list[Row]:
    """Rebuild the workforce marts under ``out_dir`` and return the check report."""
    models = WorkforceModels(raw, as_of, share=True)
    sources = workforce_sources(raw)

    def rules(names: set[str]) -> DataFrame:
        return run_checks([rule(models) for name, rule in workforce_checks.RULES.items() if name in names])

    early = set(workforce_checks.STAGING_RULES)
    run = _Run(
        models,
        ["stg_employees", "stg_payroll"],
        ["stint_records", "stint_spans", "int_person_employment_history"],
        lambda: workforce_checks.schema_test_report(models, staged=True).unionByName(rules(early)),
        lambda: workforce_checks.schema_test_report(models, staged=False).unionByName(
            rules(set(workforce_checks.RULES) - early)
        ),
        lambda: workforce_checks.row_rules(models),
        sources,
        _fingerprint([raw.departments, *(table for table, _ in sources.values())], "workforce", as_of),
        WORKFORCE_KEYS,
    )
    return _publish(run, out_dir, fresh_at, keeping)
