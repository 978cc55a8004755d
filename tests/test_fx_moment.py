"""The last quote before every trip, whatever the buckets."""

import bisect
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlane.operators import fx_moment

START = datetime(2024, 2, 28, 22)


def frames(spark, trips, quotes):
    kinds = "currency string, quoted_at timestamp_ntz, quote_id long, r double"
    given = spark.createDataFrame(quotes, kinds).withColumn("usd_rate", F.col("r").cast("decimal(10,4)")).drop("r")
    return spark.createDataFrame(trips, "trip_id long, currency string, requested_at timestamp_ntz, at string"), given


def brute_force(trips, quotes):
    by_currency = {}
    for currency, at, quote_id, rate in sorted((q for q in quotes if None not in q), key=lambda q: (q[1], q[2])):
        by_currency.setdefault(currency, []).append((at, rate))
    want = []
    for trip_id, currency, at, _ in trips:
        known = by_currency.get(currency, [])
        if at is None or not known:
            want.append((trip_id, None, None, False))
            continue
        place = bisect.bisect_right([q[0] for q in known], at)
        moment, rate = known[max(place - 1, 0)]
        want.append((trip_id, rate, moment, place == 0))
    return sorted(want)


@pytest.mark.parametrize("minutes", [1, 60, 60 * 24 * 30])
def test_every_trip_takes_the_last_quote_before_it(spark, minutes):
    draw = random.Random(7)
    moments = [START + timedelta(minutes=draw.randrange(60 * 36)) for _ in range(40)]  # few, so that times coincide
    quotes = [(draw.choice(["GBP", "EUR"]), draw.choice(moments), k, (100 + k) / 100) for k in range(60)]
    quotes += [("GBP", None, 90, 9.0), (None, START, 91, 9.0), ("EUR", START, 92, None)]
    trips = [(k, draw.choice(["GBP", "GBP", "EUR", "CHF"]), draw.choice(moments) + timedelta(seconds=draw.choice([-1, 0, 1])), "x") for k in range(400)]
    trips += [(900, "GBP", None, "x"), (901, None, START, "x"), (902, "GBP", START - timedelta(days=80), "x"), (903, "EUR", datetime(1969, 12, 31, 23, 59), "x")]
    trips += trips[:5]
    asked, given = frames(spark, trips, quotes)
    got = fx_moment.rates_at_moment(asked, given, bucket_minutes=minutes)
    assert got.columns == [*asked.columns, "moment_rate", "rate_quoted_at", "is_filled_back"]
    rows = [(r.trip_id, None if r.moment_rate is None else float(r.moment_rate), r.rate_quoted_at, r.is_filled_back) for r in got.collect()]
    assert sorted(rows) == brute_force(trips, quotes)


def test_no_quotes_and_no_trips(spark):
    asked, given = frames(spark, [(1, "GBP", START, "x")], [("GBP", START, 1, 1.2)])
    nothing = fx_moment.rates_at_moment(asked, given.limit(0)).first()
    assert (nothing.moment_rate, nothing.is_filled_back) == (None, False)
    assert fx_moment.rates_at_moment(asked.limit(0), given).count() == 0


def test_windows_run_over_buckets_only(spark):
    asked, given = frames(spark, [(1, "GBP", START, "x")], [("GBP", START, 1, 1.2)])
    plan = fx_moment.rates_at_moment(asked, given)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    heavy = [line for line in plan.splitlines() if "Exchange hashpartitioning(currency" in line and "bucket" not in line]
    assert len(heavy) == 1  # the table of one row per bucket
