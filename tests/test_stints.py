"""Stint stitching against brute force on shapes the projected data does not contain."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from fixtures import employees, workforce
from pyspark.sql import functions as F

from ledgerlane.functions.groups import first_per_group, losers, number_in_group
from ledgerlane.operators.people_attrition import attrition_monthly, attrition_standard

DAY = date(2016, 1, 1)


def brute_force(rows):
    """employee_id -> (record type, stint id) by walking every chain; cycles are left out."""
    status = {r[0]: r[4] for r in rows}
    prior = {r[0]: r[5] for r in rows}

    def kind(employee):
        if prior[employee] is None:
            return "new_stint"
        return {"transferred": "transfer_continuation", "terminated": "rehire_new_stint"}.get(
            status.get(prior[employee]), "new_stint"
        )

    placed = {}
    for employee in status:
        at, seen = employee, set()
        while kind(at) == "transfer_continuation" and at not in seen:
            seen.add(at)
            at = prior[at]
        if kind(at) != "transfer_continuation":
            placed[employee] = (kind(employee), at)
    return placed


def spread(employee):
    return str(DAY + timedelta(days=employee % 3000))


def chain(first, length, person, last="active"):
    ids = range(first, first + length)
    return [
        (e, person, spread(e), spread(e + 1), "transferred" if e < first + length - 1 else last, e - 1 if e > first else None)
        for e in ids
    ]


CASES = {
    "long chain": chain(100, 37, 1),
    "cycle": [(1, 1, "2016-01-01", "2016-02-01", "transferred", 3), (2, 1, "2016-02-01", "2016-03-01", "transferred", 1),
              (3, 1, "2016-03-01", "2016-04-01", "transferred", 2), (4, 1, "2016-04-01", None, "active", 3),
              (5, 2, "2016-04-01", None, "active", None)],
    "self loop": [(1, 1, "2016-01-01", "2016-02-01", "transferred", 1), (2, 1, "2016-02-01", None, "active", 1)],
    "cycle beside a long chain": chain(100, 20, 1)
    + [(1, 2, "2016-01-01", "2016-02-01", "transferred", 2), (2, 2, "2016-02-01", "2016-03-01", "transferred", 1)],
    "shared predecessor": [(1, 1, "2016-01-01", "2016-02-01", "transferred", None)]
    + [(e, 1, spread(e), None, "active", 1) for e in range(2, 40)],
    "missing predecessor": [(2, 1, "2016-01-01", None, "active", 99)],
    "active predecessor": [(1, 1, "2016-01-01", None, "active", None), (2, 1, "2017-01-01", None, "active", 1)],
    "no links": [(e, e, spread(e), None, "active", None) for e in range(1, 5)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_stints_match_brute_force(spark, data, name):
    rows = CASES[name]
    models = workforce(spark, data, employees=employees(spark, rows))
    got = {r.employee_id: (r.record_type, r.stint_id) for r in models.stint_records.collect()}
    assert got == brute_force(rows)


def test_random_records_match_brute_force(spark, data):
    rng = random.Random(7)
    rows = []
    for e in range(1, 400):
        status = rng.choices(["transferred", "terminated", "active"], [6, 2, 2])[0]
        prior = rng.choice([None, rng.randint(1, 420), max(1, e - 1), max(1, e - 1)])
        rows.append((e, e % 17, spread(e * 7), spread(e * 7 + 30), status, prior))
    models = workforce(spark, data, employees=employees(spark, rows))
    got = {r.employee_id: (r.record_type, r.stint_id) for r in models.stint_records.collect()}
    assert got == brute_force(rows)


def test_rehire_opens_a_second_stint(spark, data):
    rows = [
        (1, 1, "2016-01-01", "2017-01-01", "terminated", None),
        (2, 1, "2018-01-01", "2019-01-01", "transferred", 1),
        (3, 1, "2019-01-01", None, "active", 2),
    ]
    models = workforce(spark, data, employees=employees(spark, rows))
    stints = {r.employee_id: (r.stint_id, r.stint_number) for r in models.int_employment_stints.collect()}
    assert stints == {1: (1, 1), 2: (2, 2), 3: (2, 2)}
    person = models.int_person_employment_history.collect()[0]
    served = (date(2017, 1, 1) - date(2016, 1, 1)).days + (date(2025, 12, 31) - date(2018, 1, 1)).days
    assert person.tenure_total_service_days == served
    assert person.tenure_continuous_days == (date(2025, 12, 31) - date(2016, 1, 1)).days
    assert person.tenure_current_stint_days == (date(2025, 12, 31) - date(2018, 1, 1)).days
    assert (person.total_stints, person.total_transfers, person.current_employee_id) == (2, 1, 3)


def test_numbers_of_a_hot_group_equal_a_plain_window(spark):
    rng = random.Random(3)
    rows = [(1 if i % 3 else i % 11, str(DAY + timedelta(days=rng.randint(0, 50))), i) for i in range(900)]
    rows += [(1, None, 901), (1, None, 900), (None, "2016-01-01", 902)]
    df = spark.createDataFrame(rows, "g long, a string, b long").selectExpr("g", "cast(a as date) as a", "b")
    # Rows without a date come first; the group without a key has no position to give.
    want = {}
    seen = Counter()
    for g, _, b in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or "", r[2])):
        seen[g] += 1
        want[b] = seen[g]
    got = number_in_group(df, "g", "a", ["b"], "n").where("g is not null")
    assert {r.b: r.n for r in got.collect()} == want


def test_dedup_keeps_and_reports_every_row_of_a_hot_group(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) as k", "id % 97 as at", "id")
    kept = first_per_group(df, ["k"], [F.col("at").asc(), F.col("id").asc()], repeat_flag="again")
    dropped = losers(df, ["k"], "id", F.min(F.struct("at", "id")), "kept")
    assert kept.count() + dropped.count() == 3000
    assert [(r.k, r.id) for r in kept.where("again").collect()] == [(0, 0)]
    assert dropped.where("kept <> 0").count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def spans(spark, rows):
    text = spark.createDataFrame(rows, "stint_id long, person_id long, s string, e string")
    return text.selectExpr(
        "stint_id", "person_id", "cast(s as date) as stint_start_date", "cast(e as date) as stint_end_date"
    )


def months(rows):
    """From the month of the earliest start to December 2025."""
    first = min(start for _, _, start, _ in rows)
    numbers = range(first.year * 12 + first.month - 1, 2025 * 12 + 12)
    return [date(n // 12, n % 12 + 1, 1) for n in numbers]


def following(day):
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


def random_spans(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        start = date(2015, 10, 1) + timedelta(days=rng.randint(0, 3700))
        if rng.random() < 0.3:
            start = start.replace(day=1)
        end = start + timedelta(days=rng.choice([0, 1, 20, 45, 300, 1500]))
        if rng.random() < 0.3:
            end = following(end)
        rows.append((i, i % 40, start, None if rng.random() < 0.2 or end > date(2025, 12, 31) else end))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_headcounts_match_brute_force(spark, seed):
    rows = random_spans(seed)
    df = spans(spark, [(i, p, str(s), str(e) if e else None) for i, p, s, e in rows])
    any_time = {
        m: len({p for _, p, s, e in rows if s <= following(m) and (e is None or e > m)}) for m in months(rows)
    }
    monthly = attrition_monthly(df, date(2025, 12, 31)).collect()
    assert {r.month_start: r.active_headcount_eom for r in monthly} == {m: n for m, n in any_time.items() if n}
    for r in monthly:
        inside = [row for row in rows if r.month_start <= row[2] < following(r.month_start)]
        assert r.hires == len(inside)
        first = {p: min((s, i) for i, q, s, _ in rows if q == p) for p in range(40)}
        assert r.rehires == sum((s, i) != first[p] for i, p, s, _ in inside)
        assert r.exits == sum(e is not None and r.month_start <= e < following(r.month_start) for *_, e in rows)

    def closing(day):
        return len({p for _, p, s, e in rows if s <= day and (e is None or e > day)})

    for r in attrition_standard(df, date(2025, 12, 31)).collect():
        shut = following(r.month_start) - timedelta(days=1)
        opened = date(shut.year - 1, shut.month, 1)
        opened = following(opened) - timedelta(days=1)
        assert (r.opening_headcount, r.closing_headcount) == (closing(opened), closing(shut))
        left = {p for _, p, _, e in rows if e is not None and opened < e <= shut}
        assert r.exits_12m == len(left)


def test_series_covers_the_dates_of_the_data(spark):
    rows = [(1, 1, "2012-05-10", None), (2, 2, "2026-03-01", "2026-04-15"), (3, 3, None, None)]
    monthly = {r.month_start: r for r in attrition_monthly(spans(spark, rows), date(2026, 6, 30)).collect()}
    assert (min(monthly), max(monthly)) == (date(2012, 5, 1), date(2026, 6, 1))
    # A stint without a start is never present.
    assert monthly[date(2012, 5, 1)].active_headcount_eom == 1
    assert monthly[date(2026, 3, 1)].active_headcount_eom == 2
    assert (monthly[date(2026, 3, 1)].hires, monthly[date(2026, 4, 1)].exits) == (1, 1)


def test_two_exits_in_one_window_are_one_person(spark):
    rows = [(1, 1, "2020-01-10", "2021-02-01"), (2, 1, "2021-04-01", "2021-08-01"), (3, 2, "2020-01-01", None)]
    got = {r.month_start: r.exits_12m for r in attrition_standard(spans(spark, rows), date(2022, 12, 31)).collect()}
    assert got[date(2021, 12, 1)] == 1
    assert (got[date(2022, 7, 1)], got[date(2022, 8, 1)]) == (1, 0)


def test_losers_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 1, 6), (2, 1, 7), (2, 1, 8), (3, None, 9)], "a int, b int, id int")
    dropped = losers(df, ["a", "b"], "id", F.min(F.struct("id")), "kept")
    assert sorted((r.id, r.kept) for r in dropped.collect()) == [(6, 5), (8, 7)]
