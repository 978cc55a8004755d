"""Quantiles from cells stay within their bound, and sketches add up."""

import random

import pytest
from fixtures import ride
from pyspark.sql import functions as F

from ledgerlane.functions.quantiles import merge, quantiles, sketch
from ledgerlane.operators import ride_eta


def numbers(spark, rows):
    return spark.createDataFrame(rows, "g string, v long")


@pytest.mark.parametrize("bits", [3, 7])
def test_within_the_bound_of_exact_percentiles(spark, bits):
    draw = random.Random(bits)
    rows = [(g, int(draw.lognormvariate(mu, 2)) * draw.choice([1, 1, 1, -1])) for g, mu in (("a", 3), ("b", 9), ("c", 30)) for _ in range(997)]
    rows += [("one", 2**62 + 12345), ("zero", 0), ("small", 2**bits - 1), ("null", None), (None, 5)]
    given = numbers(spark, rows)
    percents = {f"p{p}": p for p in (1, 50, 90, 100)}
    got = {r.g: r for r in quantiles(sketch(given, ["g"], "v", bits), ["g"], percents).collect()}
    assert set(got) == {"a", "b", "c", "one", "zero", "small", None}
    for group, row in got.items():
        values = sorted(v for g, v in rows if g == group and v is not None)
        assert row.n == len(values)
        for name, p in percents.items():
            exact = values[-(-p * len(values) // 100) - 1]
            assert abs(row[name] - exact) <= abs(exact) / 2**bits
    assert got["small"].p50 == 2**bits - 1 and got["zero"].p50 == 0


def test_sketches_of_parts_add_up(spark):
    rows = [(draw, draw_2 * 37 % 1009) for draw in "ab" for draw_2 in range(600)]
    whole = sketch(numbers(spark, rows), ["g"], "v")
    parts = [sketch(numbers(spark, rows[k::3]), ["g"], "v") for k in range(3)]
    added = merge(parts[0].union(parts[1]).union(parts[2]), ["g"])
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, whole.collect()))
    everything = sketch(numbers(spark, rows), [], "v")
    assert sorted(map(tuple, merge(whole, []).collect())) == sorted(map(tuple, everything.collect()))
    assert whole.count() < 2 * 600


def test_bands_match_exact_percentiles(spark, data):
    models = ride(spark, data)
    found = ride_eta.eta_bands(ride_eta.eta_sketch(models.stg_trips)).where("level = 'city' and measure = 'ride_seconds'").collect()
    done = models.stg_trips.where("is_completed").selectExpr("city", "cast(ended_at - started_at as decimal(20,0)) as s").collect()
    assert len(found) == len({r.city for r in done}) > 1
    for row in found:
        exact = sorted(int(r.s) for r in done if r.city == row.city)
        assert row.trips == len(exact)
        for got, p in ((row.median, 50), (row.p90, 90)):
            want = exact[-(-p * len(exact) // 100) - 1]
            assert abs(got - want) <= want / 128


def test_missing_and_backward_times(spark, data):
    trips = ride(spark, data).stg_trips
    odd = trips.withColumns(
        {
            "started_at": F.expr("if(trip_id % 3 = 0, null, started_at)"),
            "ended_at": F.expr("if(trip_id % 5 = 0, started_at - interval 9 seconds, ended_at)"),
            "pickup_lat": F.expr("if(trip_id % 7 = 0, null, pickup_lat)"),
        }
    )
    total = {r.measure: r.trips for r in ride_eta.eta_bands(ride_eta.eta_sketch(odd)).where("level = 'all'").collect()}
    done = odd.where("is_completed")
    assert total["pickup_seconds"] == done.where("started_at is not null").count()
    timed = done.where("started_at is not null and ended_at >= started_at")
    assert total["ride_seconds"] == timed.count() < total["pickup_seconds"]
    assert total["metres_an_hour"] == timed.where("ended_at > started_at and pickup_lat is not null").count()
    assert ride_eta.eta_bands(ride_eta.eta_sketch(trips.limit(0))).count() == 0
