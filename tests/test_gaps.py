"""Payroll against employment record by record, service after resets, and sets of ranges."""

import random
from datetime import date

from fixtures import employees, workforce
from pyspark.sql import functions as F
from test_payroll import runs

from ledgerlane.functions.ranges import in_one_only, islands, merged
from ledgerlane.operators import people_departments, people_service
from ledgerlane.plans.registry import _pay_gaps, _tieout


def gaps_of(models):
    return sorted(
        ((r.employee_id, r.department_id, r.kind, r.first_month, r.last_month, r.months) for r in _pay_gaps(models)[1].collect()), key=str
    )


def test_offsetting_errors_do_not_tie_out(spark, data):
    people = employees(
        spark, [(1, 1, "2014-03-01", "2014-05-31", "terminated", None), (2, 2, "2014-06-01", "2014-06-30", "terminated", None)]
    )
    pay = runs(spark, [(1, 2, "2014-04-01", 10.0), (2, 1, "2014-03-01", 10.0), (3, 1, "2014-05-01", 10.0), (4, 2, "2014-06-01", 10.0)])
    models = workforce(spark, data, employees=people, payroll=pay)
    rows = {r.pay_month: r for r in _tieout(models).collect()}
    april = rows[date(2014, 4, 1)]
    assert (april.record_difference, april.paid_not_employed, april.employed_not_paid, april.ties_out) == (0, 1, 1, False)
    assert [rows[date(2014, m, 1)].ties_out for m in (3, 5, 6)] == [True] * 3
    month = date(2014, 4, 1)
    assert gaps_of(models) == [(1, 10, "employed_not_paid", month, month, 1), (2, 10, "paid_not_employed", month, month, 1)]


def test_gaps_span_months_and_follow_duplicates_and_strangers(spark, data):
    people = employees(
        spark,
        [
            (1, 1, "2014-01-15", "2014-12-10", "terminated", None),
            (9, 1, "2014-01-15", "2014-12-10", "terminated", None),  # a duplicate of record 1
            (3, 3, None, None, "active", None),
            (4, 4, "2014-05-01", "2014-01-01", "terminated", None),
        ],
    )
    months = [(f"2014-{m:02d}-01", 1 if m % 2 else 9) for m in (1, 2, 3, 7, 8, 12)]
    pay = [(k, record, month, 5.0) for k, (month, record) in enumerate(months)]
    pay += [(20, 1, "2015-01-01", 5.0), (21, 1, "2015-02-01", 5.0), (22, 77, "2013-12-01", 1.0), (23, 77, "2014-01-01", 1.0), (24, 3, "2014-01-01", 1.0)]
    models = workforce(spark, data, employees=people, payroll=runs(spark, pay))
    day = lambda y, m: date(y, m, 1)
    assert gaps_of(models) == sorted(
        [
            (1, 10, "employed_not_paid", day(2014, 4), day(2014, 6), 3),
            (1, 10, "employed_not_paid", day(2014, 9), day(2014, 11), 3),
            (1, 10, "paid_not_employed", day(2015, 1), day(2015, 2), 2),
            (3, 10, "paid_not_employed", day(2014, 1), day(2014, 1), 1),
            (77, None, "paid_not_employed", day(2013, 12), day(2014, 1), 2),
        ],
        key=str,
    )


def test_gap_months_add_up_to_the_differences(spark, data):
    models = workforce(spark, data)
    signed = F.when(F.col("kind") == "paid_not_employed", F.col("months")).otherwise(-F.col("months"))
    gaps = _pay_gaps(models)[1].agg(F.sum(signed).alias("net"), F.sum("months").alias("all")).first()
    tied = _tieout(models)
    sums = tied.agg(
        F.sum("record_difference").alias("net"), F.sum(F.col("paid_not_employed") + F.col("employed_not_paid")).alias("all")
    ).first()
    assert (gaps.net or 0, gaps["all"] or 0) == tuple(sums)
    assert tied.where("ties_out and paid_not_employed + employed_not_paid > 0").count() == 0


def test_transfers_of_an_unlisted_department_agree(spark, data):
    people = employees(
        spark,
        [
            (1, 1, "2020-01-01", "2021-03-01", "transferred", None), (2, 1, "2021-03-01", None, "active", 1),
            (3, 3, "2020-01-01", "2021-05-01", "terminated", None),
        ],
    )
    moved = people.withColumn("department_id", F.expr("case employee_id when 1 then 99L when 3 then null else 10L end"))
    models = workforce(spark, data, employees=moved)
    rows = people_departments.department_movements(models.stint_records, models.int_person_employment_history, models.stg_departments).collect()
    company = next(r for r in rows if r.level == "company")
    assert (company.transfers_in, company.transfers_out, company.exits) == (1, 1, 1)
    by_department = {r.department_id: r for r in rows if r.level == "department"}
    assert (by_department[99].transfers_out, by_department[99].division, by_department[10].transfers_in) == (1, None, 1)
    assert by_department[None].exits == 1


def bridged(spark, data, people, **options):
    models = workforce(spark, data, employees=employees(spark, people))
    df = people_service.tenure_bridged(models.stint_spans, models.int_person_employment_history, models.as_of, **options)
    return {r.person_id: r for r in df.collect()}


def test_overlaps_count_once_and_long_absences_reset(spark, data):
    people = [
        (1, 1, "2020-01-01", "2020-12-31", "terminated", None), (2, 1, "2020-07-01", "2021-01-01", "terminated", 1),
        (3, 2, "2010-01-01", "2011-01-01", "terminated", None), (4, 2, "2012-12-30", "2013-12-30", "terminated", 3),
        (5, 2, "2015-12-30", None, "active", 4),
        (6, 3, "2010-01-01", "2010-01-11", "terminated", None), (7, 3, "2012-01-11", "2012-01-21", "terminated", 6),
        (8, 4, None, None, "active", None),
    ]
    rows = bridged(spark, data, people)
    # 365 and 184 days within 366; the overlap is a line of its own.
    assert (rows[1].tenure_total_service_days, rows[1].overlapping_days, rows[1].bridged_service_days, rows[1].clock_days) == (549, 183, 366, 366)
    # 729 days away do not reset, 730 do.
    assert (rows[2].service_resets, rows[2].times_away, rows[2].service_since) == (1, 2, date(2015, 12, 30))
    assert rows[2].days_before_reset == 365 + 365
    assert (rows[3].bridged_service_days, rows[3].days_before_reset, rows[3].service_resets) == (10, 10, 1)
    assert (rows[4].bridged_service_days, rows[4].service_since) == (0, None)
    kept = bridged(spark, data, people, reset_days=5000)
    assert (kept[2].service_resets, kept[2].days_before_reset) == (0, 0)


def test_steps_add_up_and_never_exceed_the_clock(spark, data):
    models = workforce(spark, data)
    df = people_service.tenure_bridged(models.stint_spans, models.int_person_employment_history, models.as_of, reset_days=200)
    adds_up = F.expr("tenure_total_service_days - overlapping_days - days_before_reset = bridged_service_days")
    within = F.expr("bridged_service_days between 0 and clock_days and overlapping_days >= 0")
    on_clock = F.expr("is_currently_active = 0 or clock_days = tenure_continuous_days")
    assert df.where(~(adds_up & within & on_clock)).count() == 0
    assert df.where("service_resets > 0").count() > 0


def numbers(ranges):
    return {n for lo, hi in ranges for n in range(lo, hi + 1)}


def test_sets_of_ranges_against_sets_of_numbers(spark):
    rng = random.Random(8)
    sides = [[(k, lo, lo + rng.randint(0, 6)) for k in range(40) for lo in rng.sample(range(40), rng.randint(0, 5))] for _ in range(2)]
    first, second = (spark.createDataFrame(side, "key int, lo int, hi int") for side in sides)
    found = in_one_only(first, second, ["key"]).collect()
    united = islands(first.selectExpr("key", "explode(sequence(lo, hi)) as at"), ["key"], "at").collect()
    day = "date_add(date'2000-01-01', {})"
    dated = first.selectExpr("key", *[f"{day.format(end)} as {end}" for end in ("lo", "hi")])
    for k in range(40):
        a, b = (numbers((lo, hi) for key, lo, hi in side if key == k) for side in sides)
        own = [r for r in found if r.key == k]
        assert numbers((r.lo, r.hi) for r in own if r.in_first) == a - b
        assert numbers((r.lo, r.hi) for r in own if not r.in_first) == b - a
        assert len(own) == sum(n - 1 not in s - t for s, t in ((a, b), (b, a)) for n in s - t)
        assert sorted((r.lo, r.hi) for r in united if r.key == k) == sorted(
            (n, next(m for m in range(n, 99) if m + 1 not in a)) for n in a if n - 1 not in a
        )
    for gap in (0, 3):
        chained = merged(dated, ["key"], gap).collect()
        for k in range(40):
            own = sorted((lo, hi) for key, lo, hi in sides[0] if key == k)
            want = []
            for lo, hi in own:
                if want and lo - want[-1][1] <= gap:
                    want[-1][1] = max(hi, want[-1][1])
                else:
                    want.append([lo, hi])
            assert sorted(((r.lo - date(2000, 1, 1)).days, (r.hi - date(2000, 1, 1)).days) for r in chained if r.key == k) == sorted(map(tuple, want))


def test_empty_sets_of_ranges(spark):
    none = spark.createDataFrame([], "key int, lo int, hi int")
    assert in_one_only(none, none, ["key"]).count() == 0
    assert islands(none, ["key"], "lo").count() == 0
    assert merged(spark.createDataFrame([], "key int, lo date, hi date"), ["key"]).count() == 0
