"""Versions of published rows, and restated periods whose causes add up."""

from datetime import datetime, timezone
from types import SimpleNamespace

from fixtures import ride
from pyspark.sql import functions as F

from ledgerlane.operators import history
from ledgerlane.plans.publish import mart_versions, publish_ride
from ledgerlane.plans.registry import CLOSED_AT, REVIEW_DAYS, _period_restatement
from ledgerlane.plans.ride import RideModels
from ledgerlane.sources.ride_projection import ProjectedRideTables


def now_utc():
    return datetime.now(timezone.utc).replace(tzinfo=None)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "id long, part string, amount int, note string")


def test_differences_and_versions(spark):
    runs = [
        [(1, "a", 5, None), (2, None, 6, ""), (3, "c", 7, "x"), (None, "d", 1, None)],
        [(1, "a", 5, None), (2, None, 6, None), (4, "e", 0, None), (None, "d", 2, None)],
        [(1, "a", 5, None), (2, None, 6, None), (3, "c", 7, "x"), (None, "d", 2, None)],
    ]
    keys, before, log = ["id", "part"], rows_of(spark, []), None
    for k, rows in enumerate(runs, 1):
        after = rows_of(spark, rows)
        found = history.differences(before, after, keys)
        if k == 2:
            assert sorted(((r.id, r.change) for r in found.collect()), key=str) == [(2, "changed"), (3, "removed"), (4, "added"), (None, "changed")]
        found = found.withColumn("run_at", F.lit(datetime(2024, 1, k)))
        log, before = found if log is None else log.union(found), after
    kept = history.versions(log, keys)
    assert kept.where("id = 3").count() == 2 and kept.where("valid_to is null").count() == 4
    for k, rows in enumerate(runs, 1):
        assert sorted(map(str, history.at_time(kept, datetime(2024, 1, k, 12)).collect())) == sorted(map(str, rows_of(spark, rows).collect()))
    assert history.differences(before, before, keys).count() == 0


def test_published_marts_can_be_read_as_they_stood(spark, data, tmp_path):
    raw, out = ProjectedRideTables(spark, data), f"{tmp_path}/out"
    publish_ride(raw, out)
    first = now_utc()
    riders = lambda: mart_versions(spark, out, "mart_riders", ["rider_id"])
    assert riders().where("valid_to is not null").count() == 0
    gone = raw.trips.where("rider_id <> 2")
    publish_ride(ride(spark, data, trips=gone, payments=raw.payments.join(gone, "trip_id", "left_semi")).raw, out)
    changed = riders().where("valid_to is not null").collect()
    assert [r.rider_id for r in changed] == [2] and changed[0].completed_trips > 0
    before = history.at_time(riders(), first).where("rider_id = 2").first()
    now = history.at_time(riders(), now_utc()).where("rider_id = 2").first()
    assert (before.completed_trips, now.completed_trips) == (changed[0].completed_trips, 0)


def test_causes_add_up_to_the_change_of_the_figures(spark):
    data = "/root/testdata/sf0.01"  # large enough for captures around the closing hour
    raw = ProjectedRideTables(spark, data)
    early = SimpleNamespace(riders=raw.riders, drivers=raw.drivers)
    early.trips, early.payments, early.driver_incentives = history.as_known(raw.trips, raw.payments, raw.driver_incentives, CLOSED_AT, REVIEW_DAYS)
    net = "sum(if(is_revenue_eligible and has_captured_payment, captured_amount_usd - processor_fee_usd, 0)) as net"
    figures = [
        RideModels(tables).int_trips_enriched.where(F.col("requested_at") <= F.lit(str(CLOSED_AT)).cast("timestamp_ntz"))
        .selectExpr(net, "sum(if(is_completed, gross_fare_usd, 0)) as gmv", "sum(incentive_amount_usd) as inc").first()
        for tables in (early, raw)
    ]
    found = _period_restatement(spark, data)
    sums = found.agg(F.sum("net_revenue_change_usd"), F.sum("gmv_change_usd"), F.sum("incentives_change_usd")).first()
    assert [round(x, 4) for x in sums] == [float(b - a) for a, b in zip(*figures)]
    assert {r.cause for r in found.collect()} >= {"fraud_flag", "late_capture"}


def test_every_cause(spark):
    names = ["trip_id", *history._COMPARED]
    day = datetime(2024, 3, 1)
    base = {k: (k, day, True, True, False, True, False, 10, 10, 1, 0) for k in range(8)}
    after = dict(base)
    before = dict(base)
    del before[1]
    del after[2]
    before[3] = (3, day, True, True, False, True, False, 10, 10, 1, 0)
    after[3] = (3, day, True, False, True, True, False, 10, 10, 1, 0)
    before[4] = (4, day, True, True, False, False, False, 10, 0, 0, 0)
    after[5] = (5, day, True, True, False, True, True, 10, 10, 1, 0)
    after[6] = (6, day, True, True, False, True, False, 10, 10, 1, 3)
    after[7] = (7, day, True, True, False, True, False, 12, 12, 1, 0)
    kinds = "trip_id long, requested_at timestamp_ntz, " + ", ".join(f"{n} boolean" for n in names[2:7]) + ", " + ", ".join(f"{n} int" for n in names[7:])
    frames = [spark.createDataFrame(list(side.values()), kinds) for side in (before, after)]
    got = {r.cause: (r.trips, r.gmv_change_usd, r.net_revenue_change_usd) for r in history.restatement(*frames, datetime(2024, 4, 1)).collect()}
    assert got == {
        "late_trip": (1, 10, 9), "withdrawn_trip": (1, -10, -9), "fraud_flag": (1, 0, -9), "late_capture": (1, 0, 9),
        "duplicate_capture": (1, 0, 0), "late_incentive": (1, 0, 0), "amended": (1, 2, 2),
    }
    assert history.restatement(*frames, datetime(2024, 2, 1)).count() == 0
