"""Payroll cost ties out in money, and queries that add up."""

from datetime import date

from fixtures import employees, workforce
from pyspark.sql import functions as F

from ledgerlane.functions import groups
from ledgerlane.operators import people_bridge, people_gaps, people_staging
from ledgerlane.operators.checks import ModelTests, run_model_tests
from ledgerlane.plans.registry import QUERIES, _pay_gaps, _tieout
from ledgerlane.plans.workforce import WorkforceModels
from ledgerlane.sources import workforce_projection
from ledgerlane.sources.tables import WORKFORCE_SCHEMAS, conform
from ledgerlane.sources.workforce_projection import ProjectedWorkforceTables


def runs(spark, rows):
    """Rows of (payroll, employee, month, dollars)."""
    full = [(p, e, e, month, usd, "USD", False, month) for p, e, month, usd in rows]
    df = spark.createDataFrame(
        full, "payroll_id long, employee_id long, person_id long, p string, gross_pay double, currency string, "
        "is_partial_period boolean, at string"
    )
    return conform(
        df.selectExpr("* except (p, at)", "cast(p as timestamp_ntz) as pay_period", "cast(at as timestamp_ntz) as paid_at"),
        WORKFORCE_SCHEMAS["payroll"],
    )


def tied(spark, data, people, pay):
    models = workforce(spark, data, employees=people, payroll=runs(spark, pay))
    rows = _tieout(models).collect()
    staged = models.stg_payroll.agg(F.sum("gross_pay_usd")).collect()[0][0]
    assert sum(r.payroll_usd for r in rows) == staged == sum(r.staged_usd for r in rows)
    return {(r.department_id, r.pay_month): r for r in rows}


def test_all_pay_is_in_the_tie_out(spark, data):
    people = employees(
        spark,
        [
            (1, 1, "2014-03-01", None, "active", None),
            (9, 1, "2014-03-01", None, "active", None),  # a duplicate of record 1
            (2, 2, "2010-01-01", "2010-02-20", "terminated", None),
            (3, 3, None, None, "active", None),
        ],
    )
    unlisted = people.withColumn("department_id", F.expr("if(employee_id = 2, 77L, department_id)"))
    pay = [(1, 1, "2014-03-01", 100.0), (2, 9, "2014-04-01", 50.0), (3, 2, "2010-01-01", 30.0), (4, 2, "2010-03-01", 40.0),
           (5, 55, "2014-03-01", 7.0), (6, 1, "2014-03-01", 90.0)]
    rows = tied(spark, data, unlisted, pay)
    first = rows[(10, date(2014, 3, 1))]
    assert (first.employed_records, first.paid_records, first.payroll_usd, first.ties_out) == (1, 1, 90, True)
    # The pay of the duplicate counts for the record that was kept.
    moved = rows[(10, date(2014, 4, 1))]
    assert (moved.paid_records, moved.payroll_usd, moved.ties_out) == (1, 50, True)
    # A department that is not listed, with pay before anyone else's start and after the record ended.
    assert (rows[(77, date(2010, 1, 1))].payroll_usd, rows[(77, date(2010, 1, 1))].ties_out) == (30, True)
    assert (rows[(77, date(2010, 3, 1))].employed_records, rows[(77, date(2010, 3, 1))].ties_out) == (0, False)
    # A record nobody knows has no department.
    assert rows[(None, date(2014, 3, 1))].payroll_usd == 7


def test_a_record_that_ended_before_the_others_began_is_not_employed_later(spark, data):
    people = employees(
        spark, [(1, 1, "2016-02-01", None, "active", None), (2, 2, "2014-01-01", "2015-06-30", "terminated", None)]
    )
    rows = tied(spark, data, people, [(1, 1, "2016-02-01", 10.0)])
    assert rows[(10, date(2016, 2, 1))].employed_records == 1
    assert rows[(10, date(2015, 6, 1))].employed_records == 1
    assert (10, date(2015, 7, 1)) not in rows


def test_bridges_add_up(spark, data):
    models = workforce(spark, data)
    days = [
        r.total_days
        for r in people_bridge.tenure_spread_bridge(
            models.stint_records, models.stint_spans, models.int_person_employment_history, models.as_of
        ).collect()
    ]
    assert days[0] + days[1] == days[2]
    assert sum(days[2:6]) == days[6] and days[5] == 0
    assert days[7] == days[6] - days[2]
    dropped = people_staging.dropped_records(models.raw.employees)
    records = [
        r.records for r in people_bridge.duplicate_bridge(models.raw.employees, dropped, models.stg_employees).collect()
    ]
    assert sum(records[:3]) == records[3] and sum(records[4:7]) == records[7]
    assert (records[2], records[6]) == (0, 0)
    assert records[5] < 0


def test_employee_ids_stay_unique_for_many_people(spark):
    from ledgerlane.sources.workforce_projection import _employees

    people = spark.range(1_500_000).selectExpr("id as c_custkey")
    ids = _employees(people).select("employee_id")
    assert ids.count() == ids.distinct().count()


def test_the_tenure_bridge_states_what_it_cannot_explain(spark, data):
    people = [
        (1, 1, "2020-01-01", "2020-12-31", "terminated", None), (2, 1, "2020-07-01", "2021-01-01", "terminated", 1),
        (3, 1, "2023-01-01", None, "active", 2),
    ]
    models = workforce(spark, data, employees=employees(spark, people))

    def lines(history):
        rows = people_bridge.tenure_spread_bridge(models.stint_records, models.stint_spans, history, models.as_of).collect()
        return [r.total_days for r in rows]

    history = models.int_person_employment_history
    # Two stints that overlap are 366 days of service, not 549; 730 days lie between them and the rehire.
    assert lines(history) == [1095, 0, 1095, 366, 730, 0, 2191, 1096]
    late = history.withColumn("tenure_continuous_days", F.col("tenure_continuous_days") + 7)
    assert lines(late)[5] == 7


def test_customers_are_dealt_over_tasks_before_they_become_payroll(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    people = spark.range(95).selectExpr("id as c_custkey", "cast(id % 25 as int) as c_nationkey")
    people.union(people.limit(3)).union(spark.sql("select null, 1")).coalesce(1).write.parquet(f"{folder}/customer.parquet")
    whole = ProjectedWorkforceTables(spark, folder).payroll
    assert whole.rdd.getNumPartitions() == 1
    monkeypatch.setattr(workforce_projection, "CUSTOMERS_A_TASK", 20)
    dealt = ProjectedWorkforceTables(spark, folder)
    assert dealt.payroll.rdd.getNumPartitions() == dealt.employees.rdd.getNumPartitions() == 5
    assert whole.count() == dealt.payroll.count() > 0
    assert whole.exceptAll(dealt.payroll).isEmpty()


def test_no_customers(spark, tmp_path):
    spark.createDataFrame([], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    assert ProjectedWorkforceTables(spark, str(tmp_path)).payroll.isEmpty()


def test_payroll_is_dealt_by_its_rows_and_frequent_employees_come_apart(spark, data, monkeypatch):
    paid = "timestamp_ntz'2024-01-15 00:00:00' as paid_at"
    month = "cast(add_months(date'2020-01-01', cast(id % 4 as int)) as timestamp_ntz) as pay_period"
    columns = ["id as payroll_id", "{} as employee_id", "7L as person_id", month, "cast(10 as decimal(12,2)) as gross_pay"]
    columns += ["'USD' as currency", "false as is_partial_period", paid]
    few = spark.range(90).selectExpr(*[c.format("cast(id / 6 as bigint)") for c in columns])
    many = spark.range(100, 160).selectExpr(*[c.format("cast(null as bigint)") for c in columns])
    raw = few.union(many)
    whole = people_staging.payroll(raw)
    monkeypatch.setattr(groups, "ROWS_A_TASK", 20)
    parts = groups.dealt(raw, "employee_id")
    assert [part.count() for part in parts] == [90, 60]
    assert parts[0].rdd.getNumPartitions() == 5
    dealt = people_staging.payroll(raw)
    assert dealt.count() == whole.count() == 90 - 15 * 2 + 4
    assert whole.exceptAll(dealt).isEmpty() and dealt.exceptAll(whole).isEmpty()
    plan = people_staging.payroll(few)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan


def test_pay_gaps_and_tie_out_of_dealt_payroll(spark, data, monkeypatch):
    def results():
        return [QUERIES[name](spark, data) for name in ("hr_pay_gaps_as_paid", "hr_payroll_cost_tieout")]

    whole = [frame.collect() for frame in results()]
    monkeypatch.setattr(groups, "ROWS_A_TASK", 100)
    for rows, dealt in zip(whole, results()):
        assert sorted(map(str, rows)) == sorted(map(str, dealt.collect()))


def test_records_are_merged_however_small_their_files(spark, data):
    models = WorkforceModels(ProjectedWorkforceTables(spark, data))
    gaps = _pay_gaps(models, reassign=False)[1]
    records = people_gaps.record_map(models.raw.employees, None, models.stg_employees)
    for frame in (gaps, records):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_column_tests_of_dealt_payroll(spark, monkeypatch):
    raw = spark.sql("select if(id < 30, null, id div 2) as payroll_id from range(130)")
    tests = ModelTests("raw_payroll", ["payroll_id"], ["payroll_id"], large=True)
    whole = run_model_tests(raw, tests)
    monkeypatch.setattr(groups, "ROWS_A_TASK", 20)
    dealt = run_model_tests(raw, tests)
    assert {r.test.split(":")[0]: r.failures for r in dealt.collect()} == {"unique": 50, "not_null": 30}
    assert sorted(map(str, whole.collect())) == sorted(map(str, dealt.collect()))
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
