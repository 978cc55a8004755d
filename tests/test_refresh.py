"""The monthly trip fact equals a full rebuild, and only the months that changed are written."""

from types import SimpleNamespace

import pytest
from fixtures import ride
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from ledgerlane.functions.files import children
from ledgerlane.operators import months
from ledgerlane.plans import registry
from ledgerlane.plans.refresh import PARTITION, TIMES, refresh_trips, refreshed_trips
from ledgerlane.plans.ride import RideModels
from ledgerlane.sources.ride_projection import ProjectedRideTables


@pytest.fixture(scope="module")
def feeds(spark, data, tmp_path_factory):
    """The feeds as written tables, so that a scan can be told from its filter."""
    raw, folder = ride(spark, data).raw, tmp_path_factory.mktemp("feeds")
    kept = {}
    for name in ("riders", "drivers", "trips", "payments", "driver_incentives"):
        getattr(raw, name).write.parquet(f"{folder}/{name}")
        kept[name] = spark.read.parquet(f"{folder}/{name}")
    return kept


def with_tables(feeds, **tables):
    return SimpleNamespace(**{**feeds, **tables})


def same_as_rebuilt(spark, out, raw):
    got = refreshed_trips(spark, out, raw).drop(PARTITION)
    want = RideModels(raw).int_trips_enriched
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def files(spark, out):
    """The files of every month."""
    folder = f"{out}/months"
    return {m.split("=")[1]: sorted(children(spark, f"{folder}/{m}")) for m in children(spark, folder) if "=" in m}


def rewritten(before, after):
    return sorted(m for m in before.keys() | after.keys() if before.get(m) != after.get(m))


def test_only_changed_months_are_written(spark, feeds, tmp_path):
    out, raw = str(tmp_path), with_tables(feeds)
    assert len(refresh_trips(raw, out).months) == 12
    same_as_rebuilt(spark, out, raw)
    assert refresh_trips(raw, out).months == []

    # A trip of one month.
    first = files(spark, out)
    one = feeds["trips"].where("requested_at >= '2024-03-10'").orderBy("requested_at").first().trip_id
    fare = F.when(F.col("trip_id") == one, F.lit("77.70").cast("decimal(12,2)")).otherwise(F.col("gross_fare"))
    dearer = with_tables(feeds, trips=feeds["trips"].withColumn("gross_fare", fare))
    done = refresh_trips(dearer, out)
    assert done.months == ["2024-03"] == rewritten(first, files(spark, out))
    assert [(c.feed, c.month, c.rows_before == c.rows_after) for c in done.changed] == [("trips", "2024-03", True)]
    same_as_rebuilt(spark, out, dearer)

    # A payment that goes: only the months that its month of attempts reaches.
    second = files(spark, out)
    paid = feeds["payments"].where("attempted_at >= '2024-08-05' and payment_status = 'captured'").orderBy("attempted_at").first()
    unpaid = with_tables(feeds, trips=dearer.trips, payments=feeds["payments"].where(F.col("payment_id") != paid.payment_id))
    done = refresh_trips(unpaid, out)
    assert "2024-08" in done.months and set(done.months) <= {"2024-07", "2024-08"}
    assert rewritten(second, files(spark, out)) == done.months
    same_as_rebuilt(spark, out, unpaid)


def test_rows_that_move_between_months_and_find_their_trip(spark, feeds, tmp_path):
    out = str(tmp_path)
    march = "requested_at >= '2024-03-01' and requested_at < '2024-04-01'"
    known = feeds["trips"].where(f"not ({march})")
    # March's payments name unknown trips at first, then find them.
    refresh_trips(with_tables(feeds, trips=known), out)
    same_as_rebuilt(spark, out, with_tables(feeds, trips=known))
    done = refresh_trips(with_tables(feeds), out)
    assert done.months == ["2024-03"] and {c.feed for c in done.changed} == {"trips"}
    same_as_rebuilt(spark, out, with_tables(feeds))

    # Trips that move take along payments whose own month did not change.
    later = F.when(F.expr(march), F.col("requested_at") + F.expr("interval 120 days")).otherwise(F.col("requested_at"))
    moved = with_tables(feeds, trips=feeds["trips"].withColumn("requested_at", later))
    done = refresh_trips(moved, out)
    assert done.months[0] == "2024-03" and done.months[1] in ("2024-06", "2024-07")
    assert "2024-03" not in files(spark, out)
    same_as_rebuilt(spark, out, moved)

    # A change of those payments reaches the month that the trips moved to.
    ids = moved.trips.where("requested_at >= '2024-07-10' and requested_at < '2024-07-25'").select("trip_id")
    early = feeds["payments"].where("attempted_at < '2024-04-01'").join(ids, "trip_id", "left_semi").select("payment_id")
    assert early.count() > 0
    fewer = with_tables(feeds, trips=moved.trips, payments=feeds["payments"].join(early, "payment_id", "left_anti").select(feeds["payments"].columns))
    assert "2024-07" in refresh_trips(fewer, out).months
    same_as_rebuilt(spark, out, fewer)


def test_rows_without_a_time_or_trip_repeats_and_empty_feeds(spark, feeds, tmp_path):
    out = str(tmp_path)
    none = with_tables({name: df.limit(0) for name, df in feeds.items()})
    assert refresh_trips(none, out).months == [] and refreshed_trips(spark, out, none).count() == 0
    timeless = feeds["trips"].withColumn("requested_at", F.expr("if(trip_id % 5 = 0, null, requested_at)"))
    lost = feeds["payments"].withColumns(
        {"trip_id": F.expr("if(payment_id % 7 = 0, null, trip_id)"), "attempted_at": F.expr("if(payment_id % 3 = 0, null, attempted_at)")}
    )
    odd = with_tables(feeds, trips=timeless.union(timeless.where("trip_id % 50 = 1")), payments=lost.union(lost))
    assert months.NO_MONTH in refresh_trips(odd, out).months
    same_as_rebuilt(spark, out, odd)
    # One copy of repeated rows less is a change.
    odd.payments = lost
    assert refresh_trips(odd, out).months
    same_as_rebuilt(spark, out, odd)
    assert refresh_trips(none, out).months and files(spark, out) == {}
    assert refreshed_trips(spark, out, none).count() == 0


def test_a_run_that_breaks_is_made_good_even_if_the_feeds_go_back(spark, feeds, tmp_path, monkeypatch):
    out, raw = str(tmp_path), with_tables(feeds)
    refresh_trips(raw, out)
    fewer = with_tables(feeds, trips=feeds["trips"].where("requested_at < '2024-05-10' or requested_at >= '2024-05-20'"))
    write, calls = DataFrameWriter.parquet, []

    def breaking(writer, path, *args, **options):
        if "/manifests/" in path:
            calls.append(path)
            if len(calls) == 2:
                raise OSError("the store went away")
        return write(writer, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", breaking)
    with pytest.raises(OSError):
        refresh_trips(fewer, out)
    monkeypatch.undo()
    assert refresh_trips(raw, out).months == ["2024-05"]
    same_as_rebuilt(spark, out, raw)
    assert refresh_trips(raw, out).months == []
    assert len(refresh_trips(raw, out, version="2").months) == 12


def test_fingerprints_ignore_order_and_see_repeats_and_nulls(spark):
    rows = [("2024-01-05 10:00:00", 1, None), ("2024-01-31 23:59:59.999999", 2, ""), ("2024-02-01 00:00:00", 3, "x"), (None, 4, "y")]

    def printed(given, parts=1):
        df = spark.createDataFrame(given, "t string, a int, b string").repartition(parts)
        df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
        return {r.month: (r.rows, r.sum_0, r.sum_1) for r in months.fingerprints(df, "t").collect()}

    base = printed(rows)
    assert {m: v[0] for m, v in base.items()} == {"2024-01": 2, "2024-02": 1, months.NO_MONTH: 1}
    assert printed(rows[::-1], 3) == base
    assert printed([*rows, rows[0], rows[0]])["2024-01"] != base["2024-01"]
    assert printed([(rows[0][0], 1, ""), (rows[1][0], 2, None), *rows[2:]])["2024-01"] != base["2024-01"]
    assert printed([]) == {}


def test_ranges_of_months_reach_the_scan(spark, feeds):
    wanted = {"2024-01", "2024-02", "2023-12", "2024-06", "9999-12"}
    picked = feeds["payments"].where(months.in_months("attempted_at", wanted))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    # Three neighbouring months are one range; the plan's text is cut after it.
    assert "PushedFilters: [Or(Or(And(GreaterThanOrEqual(attempted_at,2023-12-01T00:00),LessThanOrEqual(attempted_at,2024-02" in plan
    keyed = feeds["payments"].withColumn("m", months.month_key("attempted_at"))
    assert picked.count() == keyed.where(F.col("m").isin(*wanted)).count() > 0
    assert feeds["payments"].where(months.in_months("attempted_at", set())).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_trips_meet_the_rows_of_all_feeds_at_once(spark, feeds):
    named = [(name, feeds[name], TIMES[name]) for name in ("payments", "driver_incentives")]
    together = months.reach(named, feeds["trips"], TIMES["trips"])
    assert plan_of(together).count("Join") == 1
    assert {r.feed for r in together.collect()} == {"payments", "driver_incentives"}


def test_months_reached_by_rows_without_a_time_or_a_known_trip(spark):
    rows = [(1, "2024-02-03"), (1, "2024-02-09"), (2, "2024-02-03"), (3, None), (9, "0000-03-01"), (None, "2024-02-03")]
    at = "cast(at as timestamp_ntz) as at"
    feed = spark.createDataFrame(rows, "trip_id long, at string").selectExpr("trip_id", at)
    trips = spark.createDataFrame([(1, "2023-12-31"), (2, None), (3, "0007-01-01"), (None, "2024-01-01")], "trip_id long, at string")
    found = months.reach([("payments", feed, "at")], trips.selectExpr("trip_id", at), "at").collect()
    assert sorted((r.month, r.trip_month) for r in found) == [
        ("2024-02", "2023-12"), ("2024-02", months.NO_TRIP), ("2024-02", months.NO_MONTH),
        ("none", "0007-01"), ("none", months.NO_TRIP),
    ]


def test_fingerprints_are_exact_sums_of_the_row_hashes(spark):
    rows = spark.range(300).selectExpr("id % 90 as trip_id", "if(id % 7 = 0, null, timestamp_ntz'2024-01-30' + make_dt_interval(int(id))) as at")
    found = {r.month: (r.rows, r.sum_0, r.sum_1) for r in months.fingerprints(rows, "at").collect()}
    hashes, want = months.row_hashes(rows.columns), {}
    for r in rows.select(months.month_key("at").alias("month"), *[h.alias(f"h{i}") for i, h in enumerate(hashes)]).collect():
        n, a, b = want.get(r.month, (0, 0, 0))
        want[r.month] = (n + 1, a + r.h0, b + r.h1)
    assert found == {month: (n, str(a), str(b)) for month, (n, a, b) in want.items()}
    assert "none" in found and len(found) > 10


def test_the_query_derives_all_feeds_from_trips_that_are_written_once(spark, data, monkeypatch):
    seen = []
    monkeypatch.setattr(registry.refresh, "refresh_trips", lambda raw, out_dir: seen.append(raw))
    monkeypatch.setattr(registry.refresh, "refreshed_trips", lambda *_: None)
    registry._refreshed(spark, data)
    closed, now = seen
    for raw in (closed, now):
        for name in TIMES:
            assert "Join" not in plan_of(getattr(raw, name))
    projected = ProjectedRideTables(spark, data)
    assert now.payments.exceptAll(projected.payments).isEmpty() and projected.payments.exceptAll(now.payments).isEmpty()
