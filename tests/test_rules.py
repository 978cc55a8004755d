"""Every rule passes on clean input and reports exactly the violations planted in it."""

from datetime import datetime

import pytest
from fixtures import ride, workforce
from pyspark.sql import functions as F

from ledgerlane.operators import checks
from ledgerlane.operators.checks import ModelTests, run_checks, run_model_tests, with_status
from ledgerlane.plans import ride_checks, workforce_checks
from ledgerlane.sources.ride_projection import ProjectedRideTables
from ledgerlane.sources.workforce_projection import ProjectedWorkforceTables


def failures(check):
    return run_checks([check]).collect()[0]


def edit(df, column, value, condition):
    """``df`` with one column replaced where a condition holds, types kept."""
    changed = F.when(F.expr(condition), F.expr(value).cast(df.schema[column].dataType))
    return df.withColumn(column, changed.otherwise(F.col(column)))


RIDE_BREAKS = {
    "orphan_trips": (lambda t: {"riders": t.riders.where("rider_id <> 0")}, None),
    "orphan_payments": (lambda t: {"trips": t.trips.where("trip_id <> 13")}, 1),
    "negative_fares": (lambda t: {"trips": edit(t.trips, "gross_fare", "-1", "trip_id in (1, 2)")}, 2),
    "future_trips": (
        lambda t: {"trips": edit(t.trips, "requested_at", "timestamp_ntz'2030-01-01 00:00:00'", "trip_id = 5")},
        1,
    ),
    "captured_lte_fare": (
        lambda t: {"payments": edit(t.payments, "amount", "amount * 1.2", "trip_id in (1, 3, 7)")},
        3,
    ),
    "gap_bounds": (lambda t: {"payments": t.payments.where("trip_id % 2 = 0")}, 1),
    "kpi_months": (lambda t: {"trips": t.trips.where("month(requested_at) <> 4")}, 1),
}


@pytest.mark.parametrize("name", sorted(RIDE_BREAKS))
def test_ride_rule_reports_planted_violations(spark, data, name):
    raw = ProjectedRideTables(spark, data)
    tables, planted = RIDE_BREAKS[name]
    if planted is None:
        planted = raw.trips.where("rider_id = 0").count()
        assert planted
    outcome = failures(ride_checks.RULES[name](ride(spark, data, **tables(raw)), ride_checks.DEFAULT_NOW))
    assert outcome.failures == planted
    assert outcome.status == outcome.severity


def test_incentive_recon_reports_a_changed_total(spark, data):
    models = ride(spark, data)
    models.__dict__["int_driver_metrics"] = edit(
        models.int_driver_metrics, "total_incentive_paid", "total_incentive_paid + 1", "driver_id in (1, 2)"
    )
    assert failures(ride_checks.RULES["incentive_recon"](models, ride_checks.DEFAULT_NOW)).failures == 2


def test_fraud_revenue_is_reported(spark, data):
    models = ride(spark, data)
    fraud = models.int_trips_enriched.where("is_fraud_flagged").count()
    models.__dict__["int_trips_enriched"] = edit(
        models.int_trips_enriched, "net_revenue_local", "5", "is_fraud_flagged"
    )
    outcome = failures(ride_checks.RULES["no_fraud_revenue"](models, ride_checks.DEFAULT_NOW))
    assert outcome.failures == fraud > 0


def test_rider_counts_out_of_order_are_reported(spark, data):
    models = ride(spark, data)
    models.__dict__["mart_riders"] = models.mart_riders.withColumn("is_active_90d", F.lit(False))
    assert failures(ride_checks.RULES["rider_monotonic"](models, ride_checks.DEFAULT_NOW)).failures == 1


def _copy(df, condition, **columns):
    return df.unionByName(df.where(condition).withColumns({k: F.expr(v) for k, v in columns.items()}))


WORKFORCE_BREAKS = {
    # Persons 0 to 4 hold one active record each; a second one in another department stays.
    "active_unique": (
        lambda t: {"employees": _copy(t.employees, "employee_id = 1", employee_id="90000001L", department_id="15L")},
        1,
    ),
    "orphan_payroll": (
        lambda t: {"payroll": edit(t.payroll, "employee_id", "99999999", "payroll_id = 1241930")},
        1,
    ),
    "tenure_positive": (
        lambda t: {
            "employees": edit(t.employees, "hire_date", "timestamp_ntz'2025-12-31 00:00:00'", "employee_id in (1, 21)")
        },
        2,
    ),
}


@pytest.mark.parametrize("name", sorted(WORKFORCE_BREAKS))
def test_workforce_rule_reports_planted_violations(spark, data, name):
    tables, planted = WORKFORCE_BREAKS[name]
    models = workforce(spark, data, **tables(ProjectedWorkforceTables(spark, data)))
    outcome = failures(workforce_checks.RULES[name](models))
    assert outcome.failures == planted
    assert outcome.status == outcome.severity


def test_lost_successor_is_reported(spark, data):
    rule = workforce_checks.RULES["transfer_chain"]
    raw = ProjectedWorkforceTables(spark, data)
    before = failures(rule(workforce(spark, data))).failures
    lost = raw.employees.where("employee_id <> 132")
    assert raw.employees.count() == lost.count() + 1
    assert failures(rule(workforce(spark, data, employees=lost))).failures == before + 1


def test_transfer_without_termination_is_reported(spark, data):
    """A leaver whose only closed record is a transfer has no end date and no terminated record."""
    raw = ProjectedWorkforceTables(spark, data)
    lost = raw.employees.where("employee_id <> 132")
    rule = workforce_checks.RULES["attrition_no_transfers"]
    before = failures(rule(workforce(spark, data))).failures
    assert failures(rule(workforce(spark, data, employees=lost))).failures == before + 1


@pytest.mark.parametrize(
    ("rule", "model", "condition"),
    [
        ("payroll_dedup", "stg_payroll", "payroll_id = 1241930"),
        ("review_dedup", "stg_performance_reviews", "review_id = 110"),
        ("person_grain", "fct_workforce", "person_id = 3"),
    ],
)
def test_repeated_keys_are_reported(spark, data, rule, model, condition):
    models = workforce(spark, data)
    models.__dict__[model] = _copy(getattr(models, model), condition)
    assert failures(workforce_checks.RULES[rule](models)).failures == 1


def test_headcount_that_does_not_tie_is_reported(spark, data):
    models = workforce(spark, data)
    models.__dict__["dim_department"] = models.dim_department.where("department_id <> 10")
    assert failures(workforce_checks.RULES["dept_ties"](models)).failures == 1


def test_broken_stint_is_reported(spark, data):
    models = workforce(spark, data)
    models.__dict__["stint_records"] = edit(models.stint_records, "stint_id", "-1", "employee_id = 132")
    outcome = failures(workforce_checks.RULES["stint_continuity"](models))
    assert outcome.failures >= 1


def test_generic_checks_find_planted_rows(spark):
    rows = spark.createDataFrame(
        [(1, "a", 0.5), (1, "b", 2.0), (2, None, -1.0), (None, "c", 1.0), (None, "a", None)],
        "k int, v string, x double",
    )
    parents = spark.createDataFrame([(1,), (None,)], "k int")
    assert checks.not_null(rows, "k").count() == 2
    assert [r.k for r in checks.unique(rows, "k").collect()] == [1]
    assert checks.accepted_values(rows, "v", ["a", "b"]).count() == 1
    assert checks.accepted_range(rows, "x", 0, 1).count() == 2
    assert [tuple(r) for r in checks.relationships(rows, "k", parents, "k").collect()] == [(2, 1)]


def test_model_tests_count_in_one_pass_what_the_single_checks_count(spark):
    rows = spark.createDataFrame(
        [(1, 7, "a", 0.5), (1, 8, "z", 2.0), (2, 8, None, -1.0), (None, 8, "c", 1.0), (None, None, "a", None)],
        "k int, j int, v string, x double",
    )
    tests = ModelTests("m", ["k", "v"], ["k", "j"], {"v": ["a", "b"]}, {"x": (0, 1)})
    got = {r.test: (r.failures, r.status) for r in with_status(run_model_tests(rows, tests)).collect()}
    assert got == {
        "unique:m.k": (1, "error"),
        "unique:m.j": (1, "error"),
        "not_null:m.k": (2, "error"),
        "not_null:m.v": (1, "error"),
        "accepted_values:m.v": (2, "error"),
        "accepted_range:m.x": (2, "error"),
    }


def test_freshness_statuses(spark):
    from ledgerlane.operators.freshness import freshness

    def at(text):
        return spark.sql(f"select timestamp_ntz'{text}' as t")

    report = freshness(
        {
            "fresh": (at("2025-01-01 00:00:00"), "t"),
            "late": (at("2024-12-31 00:00:00"), "t"),
            "stale": (at("2024-12-30 00:00:00"), "t"),
            "empty": (at("2024-12-30 00:00:00").where("false"), "t"),
        },
        datetime(2025, 1, 1, 12),
    )
    assert {r.source: r.status for r in report.collect()} == {
        "fresh": "pass", "late": "warn", "stale": "error", "empty": "error",
    }
