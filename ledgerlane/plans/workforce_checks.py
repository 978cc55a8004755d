"""Data-quality rules of the workforce models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.operators.checks import (
    Check,
    ModelTests,
    is_staged,
    relationships,
    run_model_tests,
    unique,
    with_status,
)
from ledgerlane.operators.people_stints import TRANSFER
from ledgerlane.operators.quarantine import Partner, RowRules
from ledgerlane.plans.workforce import WorkforceModels

EMPLOYMENT_STATUSES = ["active", "terminated", "transferred"]

MODEL_TESTS = [
    ModelTests(
        "raw_employees",
        ["employee_id", "person_id", "department_id"],
        ["employee_id"],
        {"employment_status": EMPLOYMENT_STATUSES},
    ),
    ModelTests("raw_departments", ["department_id"], ["department_id"]),
    ModelTests("raw_performance_reviews", ["review_id"], ["review_id"]),
    ModelTests("raw_payroll", ["payroll_id"], ["payroll_id"], large=True),
    ModelTests("dim_department", ["department_id"], ["department_id"]),
    ModelTests("fct_workforce", ["person_id", "is_currently_active"], ["person_id"]),
    ModelTests("fct_attrition_monthly", ["month_start"], ["month_start"]),
]


def _model(models: WorkforceModels, name: str) -> DataFrame:
    return getattr(models.raw, name.removeprefix("raw_")) if name.startswith("raw_") else getattr(models, name)


def schema_test_report(models: WorkforceModels, staged: bool | None = None) -> DataFrame:
    """Column tests of all models, or only of raw and staged ones, or only of the others."""
    chosen = [tests for tests in MODEL_TESTS if staged is None or staged == is_staged(tests.model)]
    outcomes = [run_model_tests(_model(models, tests.model), tests) for tests in chosen]
    if staged is False:
        return with_status(reduce(DataFrame.unionByName, outcomes))
    unknown = relationships(
        models.raw.employees, "department_id", models.raw.departments, "department_id"
    )
    home = Check("relationships:raw_employees.department_id", "error", unknown, "rows_affected")
    return with_status(reduce(DataFrame.unionByName, [*outcomes, home.outcome()]))


def active_unique(models: WorkforceModels) -> Check:
    active = models.stg_employees.where(F.col("employment_status") == "active")
    return Check("active_unique", "error", unique(active, "person_id"))


def attrition_no_transfers(models: WorkforceModels) -> Check:
    """People who are gone without an end date or a terminated record: lost transfers."""
    gone = models.fct_workforce.where(
        (F.col("is_currently_active") == 0) & F.col("last_termination_date").isNull()
    ).select("person_id")
    terminated = models.stint_records.where(F.col("employment_status") == "terminated").select("person_id")
    return Check("attrition_no_transfers", "warn", gone.join(terminated, "person_id", "left_anti"))


def dept_ties(models: WorkforceModels) -> Check:
    active = models.fct_workforce.where(F.col("is_currently_active") == 1).agg(F.count("*")).scalar()
    total = models.dim_department.agg(F.sum("active_headcount").alias("dept_sum"))
    return Check("dept_ties", "error", total.withColumn("persons", active).where("dept_sum <> persons"))


def orphan_payroll(models: WorkforceModels) -> Check:
    """Pay of unknown records. Pay of a dropped duplicate counts as known, by its raw record."""
    missing = relationships(models.stg_payroll, "employee_id", models.raw.employees, "employee_id")
    return Check("orphan_payroll", "warn", missing, "rows_affected")


def payroll_dedup(models: WorkforceModels) -> Check:
    return Check("payroll_dedup", "error", unique(models.stg_payroll, "employee_id", "pay_period"))


def person_grain(models: WorkforceModels) -> Check:
    return Check("person_grain", "error", unique(models.fct_workforce, "person_id"))


def review_dedup(models: WorkforceModels) -> Check:
    repeats = unique(models.stg_performance_reviews, "employee_id", "review_period")
    return Check("review_dedup", "error", repeats)


def stint_continuity(models: WorkforceModels) -> Check:
    records = models.stint_records
    before = records.select(
        F.col("employee_id").alias("prior_employee_id"), F.col("stint_id").alias("prior_stint_id")
    )
    broken = (
        records.where(F.col("record_type") == TRANSFER)
        .join(before, "prior_employee_id")
        .where(F.col("stint_id") != F.col("prior_stint_id"))
    )
    return Check("stint_continuity", "error", broken)


def tenure_positive(models: WorkforceModels) -> Check:
    return Check("tenure_positive", "warn", models.fct_workforce.where(_no_tenure()))


def _no_tenure() -> Column:
    return (F.col("is_currently_active") == 1) & (F.col("tenure_total_service_days") <= 0)


def transfer_chain(models: WorkforceModels) -> Check:
    left = models.stg_employees.where(F.col("employment_status") == "transferred")
    followed = models.stg_employees.select(F.col("prior_employee_id").alias("employee_id"))
    followed = followed.where(F.col("employee_id").isNotNull())
    return Check("transfer_chain", "warn", left.join(followed, "employee_id", "left_anti"))


RULES = {
    rule.__name__: rule
    for rule in (
        active_unique,
        attrition_no_transfers,
        dept_ties,
        orphan_payroll,
        payroll_dedup,
        person_grain,
        review_dedup,
        stint_continuity,
        tenure_positive,
        transfer_chain,
    )
}

#: Rules that need a staged model only; they are looked at before any mart is built.
STAGING_RULES = ("active_unique", "orphan_payroll", "payroll_dedup", "review_dedup", "transfer_chain")

#: Staged models with rules of their own, and their keys.
STAGED = {"stg_employees": "employee_id", "stg_payroll": "payroll_id"}


def row_rules(models: WorkforceModels) -> list[tuple[DataFrame, RowRules]]:
    """Every model with rules that a single row can break: the column tests, and the rules above of that kind."""
    moved = F.col("employment_status") == "transferred"
    own = {
        "raw_employees": (
            {},
            {"relationships:raw_employees.department_id": Partner("department_id", models.raw.departments, "department_id")},
        ),
        "stg_employees": ({}, {"transfer_chain": Partner("employee_id", models.stg_employees, "prior_employee_id", moved)}),
        "stg_payroll": ({}, {"orphan_payroll": Partner("employee_id", models.raw.employees, "employee_id")}),
        "fct_workforce": ({"tenure_positive": _no_tenure()}, {}),
    }
    tested = {tests.model: (tests.unique[0], tests.row_conditions()) for tests in MODEL_TESTS}
    found = []
    for name, (key, conditions) in (tested | {name: (key, {}) for name, key in STAGED.items()}).items():
        more, partners = own.get(name, ({}, {}))
        found.append((_model(models, name), RowRules(name, key, conditions | more, partners)))
    return found
