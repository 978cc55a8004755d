"""Batches of quotes in any order give the daily rates of a full rebuild, and rewrite only what they reach."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlane.functions.files import children
from ledgerlane.operators.fx_rates import daily_rates
from ledgerlane.plans import rates

FIRST, LAST = date(2024, 1, 10), date(2024, 6, 20)


def quotes(spark, rows):
    given = spark.createDataFrame(rows, "currency string, quoted_on date, quote_id long, r double, note string")
    return given.withColumn("usd_rate", F.col("r").cast("decimal(10,4)")).drop("r")


def rows(df):
    return sorted((r.currency, r.rate_date, r.usd_rate, r.quoted_on) for r in df.collect())


def rebuilt(spark, given, first=FIRST, last=LAST):
    return rows(daily_rates(quotes(spark, given), F.lit(first), F.lit(last)))


def files(spark, out, table):
    found = {}
    for currency in children(spark, f"{out}/{table}"):
        if "=" in currency:
            for month in children(spark, f"{out}/{table}/{currency}"):
                found[currency[9:], month[6:]] = sorted(children(spark, f"{out}/{table}/{currency}/{month}"))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches(spark, tmp_path, seed):
    draw, out = random.Random(seed), str(tmp_path)
    given = [(draw.choice(["GBP", "EUR", "JPY"]), date(2023, 12, 1) + timedelta(days=draw.randrange(230)), k, k / 100, "x") for k in range(1, 40)]
    given += [("GBP", given[0][1], 3, 9.5, "tie"), ("GBP", given[0][1], 3, 9.25, "tie")]
    dealt = given[:]
    draw.shuffle(dealt)
    for k in range(0, len(dealt), 14):
        before = files(spark, out, "daily")
        done = rates.merge_quotes(quotes(spark, dealt[k : k + 14]), out, FIRST, LAST)
        after = files(spark, out, "daily")
        assert sorted(p for p in after if before.get(p) != after[p]) == done.daily
        assert rows(rates.stored_daily(spark, out)) == rebuilt(spark, dealt[: k + 14])
    assert rates.merge_quotes(quotes(spark, dealt[:20]), out, FIRST, LAST) == rates.Merged([], [])


def test_a_late_correction_rewrites_the_months_that_carry_it(spark, tmp_path):
    out = str(tmp_path)
    base = [("GBP", date(2024, 1, 15), 1, 1.2, ""), ("GBP", date(2024, 4, 10), 2, 1.3, ""), ("EUR", date(2024, 2, 1), 3, 1.1, "")]
    assert len(rates.merge_quotes(quotes(spark, base), out, FIRST, LAST).daily) == 12
    # February has no quote and carries January's; April carries it until its own.
    late = ("GBP", date(2024, 2, 20), 4, 1.25, "")
    done = rates.pull_quotes(quotes(spark, [*base, late]), out, FIRST, LAST)
    assert done == rates.Merged([("GBP", "2024-02")], [("GBP", "2024-02"), ("GBP", "2024-03"), ("GBP", "2024-04")])
    # A correction of the first quote also reaches the days before it.
    done = rates.pull_quotes(quotes(spark, [*base, late, ("EUR", date(2024, 2, 1), 5, 1.15, "")]), out, FIRST, LAST)
    assert done.quotes == [("EUR", "2024-02")] and {c for c, _ in done.daily} == {"EUR"} and len(done.daily) == 6
    # An older quote of the day is no news.
    assert rates.merge_quotes(quotes(spark, [("GBP", date(2024, 2, 20), 2, 9.0, "")]), out, FIRST, LAST) == rates.Merged([], [])
    # The calendar grows by what is missing.
    done = rates.merge_quotes(quotes(spark, []), out, FIRST, date(2024, 7, 3))
    assert done.daily == [(c, m) for c in ("EUR", "GBP") for m in ("2024-06", "2024-07")]
    assert rates.merge_quotes(quotes(spark, []), out, date(2024, 3, 1), date(2024, 3, 2)).daily == []
    whole = [*base, late, ("EUR", date(2024, 2, 1), 5, 1.15, "")]
    assert rows(rates.stored_daily(spark, out)) == rebuilt(spark, whole, FIRST, date(2024, 7, 3))


def test_empty_broken_and_unusable_batches(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    unusable = [(None, FIRST, 1, 1.0, ""), ("GBP", None, 2, 1.0, ""), ("GBP", FIRST, None, 1.0, ""), ("GBP", FIRST, 3, None, "")]
    assert rates.merge_quotes(quotes(spark, unusable), out, FIRST, LAST) == rates.Merged([], [])
    assert rates.stored_daily(spark, out).count() == 0 and rates.pull_quotes(quotes(spark, []), out, FIRST, LAST).daily == []

    good = [("GBP", date(2024, 3, 3), 7, 1.5, "")]
    monkeypatch.setattr(rates, "_bring_up", lambda *args: (_ for _ in ()).throw(OSError("the store went away")))
    with pytest.raises(OSError):
        rates.merge_quotes(quotes(spark, good), out, FIRST, LAST)
    monkeypatch.undo()
    done = rates.pull_quotes(quotes(spark, good), out, FIRST, LAST)
    assert done.quotes == [] and len(done.daily) == 6
    assert rows(rates.stored_daily(spark, out)) == rebuilt(spark, good)
