"""Inferred successors: the one matching that no departure and arrival would both leave."""

import random
from datetime import date, timedelta
from itertools import combinations, permutations

from fixtures import employees, workforce
from pyspark.sql import functions as F

from ledgerlane.operators import people_transfers

DAY = date(2020, 1, 1)


def day(n):
    return DAY + timedelta(days=n)


def staged(spark, data, rows):
    return workforce(spark, data, employees=employees(spark, rows))


def undeduplicated(spark, rows):
    """Records as staged, but with all that begin on one day."""
    dates = {name: F.col(name).cast("date") for name in ("hire_date", "termination_date")}
    return employees(spark, rows).withColumns(dates)


def stable_matchings(ends, starts, limit):
    """All matchings, of which those stay where no pair prefers each other to what they have: the nearest, of equally
    near departures the higher record, of equally near arrivals the lower."""
    allowed = {(d, a) for d in ends for a in starts if 0 <= a[1] - d[1] <= limit}
    found = []
    for size in range(min(len(ends), len(starts)) + 1):
        for some in combinations(ends, size):
            for order in permutations(starts, size):
                pairs = set(zip(some, order))
                if not pairs <= allowed:
                    continue
                of_end, of_start = dict(pairs), {a: d for d, a in pairs}

                def blocks(d, a):
                    mine, theirs = of_end.get(d), of_start.get(a)
                    wants = mine is None or (a[1], a[0]) < (mine[1], mine[0])
                    wanted = theirs is None or (d[1], d[0]) > (theirs[1], theirs[0])
                    return wants and wanted

                if not any(blocks(d, a) for d, a in allowed - pairs):
                    found.append({d[0]: a[0] for d, a in pairs})
    return found


def test_all_matchings_of_small_persons(spark):
    draw, rows, want = random.Random(3), [], {}
    for person in range(1, 60):
        ends, starts = [], []
        for k in range(draw.randrange(1, 4)):
            record, at = person * 100 + draw.randrange(40) * 2 + 1, draw.randrange(400, 420) * 3
            if all(record != e[0] for e in ends):
                # Named by an old record, so that its own start is not a loose end.
                rows.append((record, person, str(day(10)), str(day(at)), "transferred", person * 100 + 99))
                ends.append((record, at))
        rows.append((person * 100 + 99, person, str(day(0)), str(day(5)), "terminated", ends[0][0]))
        for k in range(draw.randrange(0, 4)):
            record, at = person * 100 + draw.randrange(40) * 2 + 2, draw.randrange(395, 440) * 3
            if all(record != s[0] for s in starts):
                rows.append((record, person, str(day(at)), None, "active", draw.choice([None, 777777])))
                starts.append((record, at))
        # The first departure is named by the old record, so it has a follower and is no loose end.
        stable = stable_matchings(ends[1:], starts, 60)
        assert len(stable) == 1
        want |= {e[0]: stable[0].get(e[0]) for e in ends[1:]}
    got = people_transfers.inferred_transfers(undeduplicated(spark, rows), max_days=60, review_days=10).collect()
    assert {r.employee_id: r.successor_id for r in got} == want
    assert sum(v is not None for v in want.values()) > 10
    assert all(r.needs_review == (r.successor_id is None or r.distance_days > 10) for r in got)


def test_records_that_cannot_be_matched(spark, data):
    rows = [
        (1, 1, "2020-01-01", "2020-01-01", "transferred", None),  # ended on its first day
        (2, 2, "2020-01-01", None, "transferred", None),  # no end
        (3, None, "2020-01-01", "2020-02-01", "transferred", None), (4, None, "2020-02-01", None, "active", None),
        (5, 5, "2020-01-01", "2020-02-01", "transferred", None), (6, 5, "2020-05-02", None, "active", None),  # 91 days
        (7, 7, "2020-01-01", "2020-02-01", "transferred", None), (8, 7, "2020-05-01", None, "active", None),  # 90 days
        (9, 9, "2020-01-01", "2020-02-01", "terminated", None), (10, 9, "2020-02-01", None, "active", None),
    ]
    got = {r.employee_id: (r.successor_id, r.needs_review) for r in people_transfers.inferred_transfers(staged(spark, data, rows).stg_employees).collect()}
    assert got == {1: (None, True), 2: (None, True), 3: (None, True), 5: (None, True), 7: (8, True)}
    none = people_transfers.inferred_transfers(staged(spark, data, rows).stg_employees.limit(0))
    assert none.count() == 0


def test_stints_with_and_without(spark, data):
    rows = [(1, 1, "2020-01-01", "2021-03-01", "transferred", None), (2, 1, "2021-03-04", "2022-01-01", "transferred", None), (3, 1, "2022-01-01", None, "active", 2)]
    models = staged(spark, data, rows)
    without = {r.employee_id: (r.stint_id, r.record_type) for r in models.int_employment_stints.collect()}
    assert without == {1: (1, "new_stint"), 2: (2, "new_stint"), 3: (2, "transfer_continuation")}
    linked = type(models)(models.raw, infer_transfers=True).int_employment_stints.collect()
    assert {r.employee_id: (r.stint_id, r.record_type, r.stint_number) for r in linked} == {
        1: (1, "new_stint", 1), 2: (1, "transfer_continuation", 1), 3: (1, "transfer_continuation", 1),
    }


def test_backtest_counts_every_transfer(spark, data):
    rows = [
        (1, 1, "2020-01-01", "2020-02-01", "transferred", None), (2, 1, "2020-02-01", None, "active", 1),
        (3, 3, "2020-01-01", "2020-02-01", "transferred", None), (4, 3, "2021-02-01", None, "active", 3),
        (5, 5, "2020-01-01", "2020-02-01", "transferred", None), (6, 5, "2020-02-03", None, "active", None), (7, 5, "2020-03-01", None, "active", 5),
        (8, 8, "2020-01-01", "2020-02-01", "transferred", None), (9, 8, "2020-02-20", None, "active", None),
        (10, 10, "2020-01-01", "2020-02-01", "transferred", None),
    ]
    got = {r.outcome: (r.transfers, r.to_review, r.max_distance_days) for r in people_transfers.backtest(staged(spark, data, rows).stg_employees).collect()}
    assert got == {"found": (1, 0, 0), "missed": (1, 1, None), "other": (1, 0, 2), "invented": (1, 1, 19), "none": (1, 1, None)}
