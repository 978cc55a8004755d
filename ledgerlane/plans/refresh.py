"""The trip fact kept by month, of which a run rewrites only the months that its feeds changed.

``out_dir/months`` holds one partition per month of request, ``out_dir/manifests`` what the feeds held when they
were built: per feed and month an order-free fingerprint, and the trip months that its rows belong to.

A trip month is built anew when its trips changed, or when a changed month of payments or incentives
reaches it now or reached it before. Of those feeds, only the months that reach it are read. So a run costs one
scan per feed for the fingerprints, and beyond that grows with what changed.

The manifest first lists the months about to be replaced and, once they are, the new fingerprints. A run
that breaks between leaves months listed, and the next one builds them whatever the feeds hold by then.
Single months are replaced one after the other, so a reader during a run may see some of them new.
The driver holds the manifest: three feeds times the calendar's months.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.files import children, delete
from ledgerlane.operators.months import NO_TRIP, fingerprints, in_months, month_key, reach
from ledgerlane.plans.ride import RideModels
from ledgerlane.sources.tables import RideTables

#: The feeds of the trip fact and the time that says which month a row is of.
TIMES = {"trips": "requested_at", "payments": "attempted_at", "driver_incentives": "earned_at"}
PARTITION = "requested_month"
_PENDING, _DEFINITION = "pending", "definition"
_MANIFEST = "feed string, month string, rows bigint, sum_0 string, sum_1 string, reaches array<string>"

Content = tuple[int, str, str]


@dataclass
class _State:
    """A manifest: content per feed and month, trip months reached, months to be built, and the fact's definition."""

    content: dict[tuple[str, str], Content] = field(default_factory=dict)
    reaches: dict[tuple[str, str], set[str]] = field(default_factory=dict)
    pending: set[str] = field(default_factory=set)
    definition: str | None = None


@dataclass(frozen=True)
class ChangedMonth:
    feed: str
    month: str
    rows_before: int
    rows_after: int
    #: Trip months that the month's rows belonged to before or belong to now.
    reached: list[str]


@dataclass(frozen=True)
class Refreshed:
    """The months that a run wrote or removed, and what it did so for."""

    months: list[str]
    changed: list[ChangedMonth]


def _latest(spark: SparkSession, out_dir: str) -> int:
    """The number of the last manifest that was written to its end; 0 for none."""
    folder = f"{out_dir}/manifests"
    done = [int(name) for name in children(spark, folder) if "_SUCCESS" in children(spark, f"{folder}/{name}")]
    return max(done, default=0)


def _load(spark: SparkSession, out_dir: str) -> _State:
    number, state = _latest(spark, out_dir), _State()
    if not number:
        return state
    for row in spark.read.schema(_MANIFEST).parquet(f"{out_dir}/manifests/{number}").collect():
        if row.feed == _PENDING:
            state.pending.add(row.month)
        elif row.feed == _DEFINITION:
            state.definition = row.month
        else:
            state.content[row.feed, row.month] = (row.rows, row.sum_0, row.sum_1)
            state.reaches[row.feed, row.month] = set(row.reaches)
    return state


def _store(spark: SparkSession, out_dir: str, state: _State) -> None:
    """Write the next manifest and drop the earlier ones; it counts from the moment it is complete."""
    rows = [(feed, month, *state.content[feed, month], sorted(state.reaches.get((feed, month), ()))) for feed, month in state.content]
    rows += [(_PENDING, month, None, None, None, []) for month in state.pending]
    rows.append((_DEFINITION, state.definition, None, None, None, []))
    number, folder = _latest(spark, out_dir) + 1, f"{out_dir}/manifests"
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{number}")
    for name in children(spark, folder):
        if int(name) < number:
            delete(spark, f"{folder}/{name}")


def _content(feeds: dict[str, DataFrame]) -> dict[tuple[str, str], Content]:
    found = [fingerprints(df, TIMES[name]).withColumn("feed", F.lit(name)) for name, df in feeds.items()]
    rows = reduce(DataFrame.unionByName, found).collect()  # as many as months
    return {(r.feed, r.month): (r.rows, r.sum_0, r.sum_1) for r in rows}


def _reaches(feeds: dict[str, DataFrame], wanted: Iterable[tuple[str, str]]) -> dict[tuple[str, str], set[str]]:
    """The trip months that these months of payments and incentives belong to."""
    found: dict[tuple[str, str], set[str]] = {key: set() for key in wanted}
    parts = [
        (name, feeds[name].where(in_months(TIMES[name], {month for feed, month in found if feed == name})), TIMES[name])
        for name in sorted({feed for feed, _ in found})
    ]
    if parts:
        for row in reach(parts, feeds["trips"], TIMES["trips"]).collect():  # pairs of months
            found[row.feed, row.month].add(row.trip_month)
    return found


def _by_month(raw: RideTables) -> DataFrame:
    return RideModels(raw).int_trips_enriched.withColumn(PARTITION, month_key(TIMES["trips"]))


def refresh_trips(raw: RideTables, out_dir: str, version: str = "") -> Refreshed:
    """Bring the monthly trip fact under ``out_dir`` up to the feeds.

    The result is that of a full rebuild. The first run, and one with another ``version`` or other columns, builds every
    month. Running again on the same feeds writes nothing.
    """
    feeds = {name: getattr(raw, name) for name in TIMES}
    spark, schema = raw.trips.sparkSession, _by_month(raw).schema
    definition = hashlib.sha256(f"{version} {schema.simpleString()}".encode()).hexdigest()[:32]
    before, now = _load(spark, out_dir), _State(_content(feeds), definition=definition)
    if before.definition != definition:
        known = {month for feed, month in before.content if feed == "trips"}
        before = _State(pending=before.pending | known)

    changed = {key for key in before.content.keys() | now.content.keys() if before.content.get(key) != now.content.get(key)}
    if not changed and not before.pending and before.definition:
        return Refreshed([], [])
    trip_months = {month for feed, month in changed if feed == "trips"}
    others = {key for key in changed if key[0] != "trips"}
    fresh = _reaches(feeds, others & now.content.keys())

    def reached(key: tuple[str, str]) -> set[str]:
        return before.reaches.get(key, set()) | fresh.get(key, set())

    affected = trip_months | before.pending
    for key in others:
        affected |= reached(key) - {NO_TRIP}
    # Rows without a trip may have found one if the trips changed.
    touched = affected | ({NO_TRIP} if trip_months else set())
    read = {key for key in now.content if key[0] != "trips" and (key in others or reached(key) & touched)}
    if trip_months:
        fresh |= _reaches(feeds, read - fresh.keys())
    now.reaches = {key: fresh.get(key, before.reaches.get(key, set())) for key in now.content if key[0] != "trips"}

    _store(spark, out_dir, _State(before.content, before.reaches, affected, before.definition))
    present = {month for month in affected if ("trips", month) in now.content}
    months = {"trips": present} | {name: {month for feed, month in read if feed == name} for name in TIMES if name != "trips"}
    part = SimpleNamespace(
        riders=raw.riders, drivers=raw.drivers, **{name: df.where(in_months(TIMES[name], months[name])) for name, df in feeds.items()}
    )
    # Files of an even size whatever the size of the months: adaptive execution splits large ones and joins small ones.
    _by_month(part).hint("rebalance", PARTITION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        PARTITION
    ).parquet(f"{out_dir}/months")
    for month in affected - present:
        delete(spark, f"{out_dir}/months/{PARTITION}={month}")
    _store(spark, out_dir, now)

    def rows(state: _State, key: tuple[str, str]) -> int:
        return state.content.get(key, (0,))[0]

    report = [
        ChangedMonth(*key, rows(before, key), rows(now, key), sorted({key[1]} if key[0] == "trips" else reached(key)))
        for key in sorted(changed)
    ]
    return Refreshed(sorted(affected), report)


def refreshed_trips(spark: SparkSession, out_dir: str, raw: RideTables) -> DataFrame:
    """The trip fact as the last run left it, with its month; a filter on the month reads its partitions only."""
    return spark.read.schema(_by_month(raw).schema).parquet(f"{out_dir}/months")
