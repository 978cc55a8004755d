"""Named queries over a star-schema folder, each ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.columns import present
from ledgerlane.functions.durable import durable, scratch_folder
from ledgerlane.operators import (
    fx_moment,
    fx_rates,
    history,
    people_attrition,
    people_bridge,
    people_departments,
    people_gaps,
    people_history,
    people_service,
    people_staging,
    people_transfers,
    ride_audits,
    ride_campaigns,
    ride_distance,
    ride_drivers,
    ride_eta,
    ride_finance,
    ride_riders,
)
from ledgerlane.operators.checks import run_checks
from ledgerlane.operators.freshness import freshness
from ledgerlane.operators.quarantine import all_broken_rows
from ledgerlane.plans import rates, refresh, ride_checks, workforce_checks
from ledgerlane.plans.publish import ride_sources, workforce_sources
from ledgerlane.plans.ride import RideModels
from ledgerlane.plans.workforce import WorkforceModels
from ledgerlane.sources.fx_quotes import project_fx_quotes
from ledgerlane.sources.ride_projection import ProjectedRideTables
from ledgerlane.sources.workforce_projection import ProjectedWorkforceTables

Query = Callable[[SparkSession, str], DataFrame]

RIDE_AS_OF = datetime(2025, 1, 1)
WORKFORCE_AS_OF = datetime(2025, 12, 31)


def ride(build: Callable[[RideModels], DataFrame]) -> Query:
    return lambda spark, folder: present(build(RideModels(ProjectedRideTables(spark, folder))))


def shared_ride(build: Callable[[RideModels], DataFrame]) -> Query:
    """For queries that read the trip fact several times."""
    return lambda spark, folder: present(build(RideModels(ProjectedRideTables(spark, folder), keep=durable)))


def workforce(build: Callable[[WorkforceModels], DataFrame], **options) -> Query:
    return lambda spark, folder: present(
        build(WorkforceModels(ProjectedWorkforceTables(spark, folder), **options))
    )


def row_counts(models: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("row_count")).withColumn("model", F.lit(name)) for name, df in models.items()]
    return reduce(DataFrame.unionByName, counts)


def _named(models: object, *names: str) -> dict[str, DataFrame]:
    return {name: getattr(models, name) for name in names}


def _latest_attrition(models: WorkforceModels) -> DataFrame:
    kept = ["month_start", "active_headcount_eom", "exits_trailing_12m", "attrition_rate_trailing_12m"]
    return models.fct_attrition_monthly.select(kept).orderBy(F.col("month_start").desc()).limit(12)


def _daily_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rates for the days that the trips cover."""
    trips = RideModels(ProjectedRideTables(spark, folder)).stg_trips
    return fx_rates.daily_rates(project_fx_quotes(spark, folder), *fx_rates.calendar_of(trips))


def _merged_rates(spark: SparkSession, folder: str) -> DataFrame:
    """The daily rates after three batches: the later half of the days, the late quotes of the earlier half, and a pull."""
    feed, out_dir = project_fx_quotes(spark, folder), scratch_folder(spark, "daily-rates")
    calendar = RideModels(ProjectedRideTables(spark, folder)).stg_trips.agg(
        F.min(F.col("requested_at").cast("date")), F.max(F.col("requested_at").cast("date"))
    )
    days = calendar.first()
    late = feed.where(F.col("quoted_on") < F.lit(CLOSED_AT).cast("date"))
    rates.merge_quotes(feed.where(F.col("quoted_on") >= F.lit(CLOSED_AT).cast("date")), out_dir, *days)
    rates.merge_quotes(late, out_dir, *days)
    rates.pull_quotes(feed, out_dir, *days)
    return present(rates.stored_daily(spark, out_dir).drop("month"))


def _fx_as_of(spark: SparkSession, folder: str) -> DataFrame:
    trips = RideModels(ProjectedRideTables(spark, folder)).stg_trips
    return present(fx_rates.convert_as_of(trips, _daily_rates(spark, folder)))


def _fx_at_moment(spark: SparkSession, folder: str) -> DataFrame:
    trips = RideModels(ProjectedRideTables(spark, folder)).stg_trips
    last_day = fx_rates.calendar_of(trips)[1]
    quotes = project_fx_quotes(spark, folder).where(F.col("quoted_on") <= last_day)
    return present(fx_moment.convert_at_moment(trips, quotes, _daily_rates(spark, folder)))


def _kpis_at_monthly_rate(spark: SparkSession, folder: str) -> DataFrame:
    trips = RideModels(ProjectedRideTables(spark, folder)).int_trips_enriched
    return present(ride_finance.kpis_at_monthly_rate(trips, fx_rates.monthly_rates(_daily_rates(spark, folder))))


def _payroll_monthly_cost(spark: SparkSession, folder: str) -> DataFrame:
    payroll = WorkforceModels(ProjectedWorkforceTables(spark, folder)).stg_payroll
    calendar = people_departments.pay_calendar(payroll)
    rates = fx_rates.monthly_rates(fx_rates.daily_rates(project_fx_quotes(spark, folder), *calendar))
    return present(people_departments.payroll_monthly_cost(payroll, rates))


def _pay_gaps(models: WorkforceModels, reassign: bool = True) -> tuple[DataFrame, DataFrame]:
    """Paid months per record, written, and the ranges in which payroll and employment disagree."""
    models.settle(["stg_employees"])  # read five times from here on
    dropped = people_staging.dropped_records(models.raw.employees) if reassign else None
    records = people_gaps.record_map(models.raw.employees, dropped, models.stg_employees)
    paid = durable(people_gaps.paid_months(models.stg_payroll, records), "paid-months")
    return paid, people_gaps.pay_employment_gaps(paid, models.stg_employees, models.as_of)


def _tieout(models: WorkforceModels) -> DataFrame:
    paid, gaps = _pay_gaps(models)
    return people_gaps.payroll_cost_tieout(paid, gaps, models.stg_employees, models.stg_departments, models.as_of)


#: When the first of two compared runs closed, and how long fraud reviews take.
CLOSED_AT, REVIEW_DAYS = datetime(2024, 7, 1), 30


def _known_at_close(raw: ProjectedRideTables) -> SimpleNamespace:
    trips, payments, incentives = history.as_known(raw.trips, raw.payments, raw.driver_incentives, CLOSED_AT, REVIEW_DAYS)
    return SimpleNamespace(riders=raw.riders, drivers=raw.drivers, trips=trips, payments=payments, driver_incentives=incentives)


def _period_restatement(spark: SparkSession, folder: str) -> DataFrame:
    """The run of mid-year against one over all that is known by now."""
    raw = ProjectedRideTables(spark, folder)
    facts = [RideModels(tables).int_trips_enriched for tables in (_known_at_close(raw), raw)]
    return present(history.restatement(*facts, CLOSED_AT))


def _refreshed(spark: SparkSession, folder: str) -> tuple[refresh.Refreshed, DataFrame]:
    """The monthly trip fact of mid-year, brought up to all that is known by now."""
    raw, out_dir = ProjectedRideTables(spark, folder), scratch_folder(spark, "trips-by-month")
    raw.__dict__["trips"] = durable(raw.trips, "raw-trips")  # all feeds come from it, and both runs read each several times
    refresh.refresh_trips(_known_at_close(raw), out_dir)
    report = refresh.refresh_trips(raw, out_dir)
    return report, refresh.refreshed_trips(spark, out_dir, raw)


def _changed_months(spark: SparkSession, folder: str) -> DataFrame:
    kinds = "feed string, month string, rows_before bigint, rows_after bigint, reached string"
    rows = [(c.feed, c.month, c.rows_before, c.rows_after, ",".join(c.reached)) for c in _refreshed(spark, folder)[0].changed]
    return spark.createDataFrame(rows, kinds)


def _relinked_stints(models: WorkforceModels) -> DataFrame:
    """Stints whose transfers are all inferred."""
    models.__dict__["stg_employees"] = people_transfers.without_transfer_links(models.stg_employees)
    return models.int_employment_stints


def _freshness(spark: SparkSession, folder: str) -> DataFrame:
    rides = ride_sources(ProjectedRideTables(spark, folder))
    people = workforce_sources(ProjectedWorkforceTables(spark, folder))
    return freshness(rides, RIDE_AS_OF).unionByName(freshness(people, WORKFORCE_AS_OF))


RIDE_MODELS = {
    "rh_stg_riders": ride(lambda m: m.stg_riders),
    "rh_stg_drivers": ride(lambda m: m.stg_drivers),
    "rh_stg_trips": ride(lambda m: m.stg_trips),
    "rh_stg_payments": ride(lambda m: m.stg_payments),
    "rh_stg_driver_incentives": ride(lambda m: m.stg_driver_incentives),
    "rh_int_trips_enriched": ride(lambda m: m.int_trips_enriched),
    "rh_int_driver_metrics": ride(lambda m: m.int_driver_metrics),
    "rh_int_rider_activity": ride(lambda m: m.int_rider_activity),
    "rh_mart_drivers": ride(lambda m: m.mart_drivers),
    "rh_mart_riders": ride(lambda m: m.mart_riders),
    "rh_mart_marketplace_kpis": ride(lambda m: m.mart_marketplace_kpis),
    "rh_mart_reconciliation": ride(lambda m: m.mart_reconciliation),
}

WORKFORCE_MODELS = {
    "hr_stg_departments": workforce(lambda m: m.stg_departments),
    "hr_stg_employees": workforce(lambda m: m.stg_employees),
    "hr_stg_payroll": workforce(lambda m: m.stg_payroll),
    "hr_stg_performance_reviews": workforce(lambda m: m.stg_performance_reviews),
    "hr_int_employment_stints": workforce(lambda m: m.int_employment_stints),
    "hr_int_payroll_monthly": workforce(lambda m: m.int_payroll_monthly),
    "hr_int_person_employment_history": workforce(lambda m: m.int_person_employment_history),
    "hr_dim_department": workforce(lambda m: m.dim_department),
    "hr_fct_workforce": workforce(lambda m: m.fct_workforce),
    "hr_fct_attrition_monthly": workforce(lambda m: m.fct_attrition_monthly),
    "hr_rpt_reconciliation_bridge": workforce(lambda m: m.rpt_reconciliation_bridge),
    "hr_workforce_kpis": workforce(lambda m: m.workforce_kpis),
}

QUALITY = {
    **{
        f"dq_rh_{name}": ride(lambda m, rule=rule: run_checks([rule(m, ride_checks.DEFAULT_NOW)]))
        for name, rule in ride_checks.RULES.items()
    },
    **{
        f"dq_hr_{name}": workforce(lambda m, rule=rule: run_checks([rule(m)]))
        for name, rule in workforce_checks.RULES.items()
    },
    "dq_rh_schema_tests": shared_ride(ride_checks.schema_test_report),
    "dq_hr_schema_tests": workforce(workforce_checks.schema_test_report, share=True),
    "rh_quarantine": shared_ride(lambda m: all_broken_rows(ride_checks.row_rules(m, ride_checks.DEFAULT_NOW))),
    "hr_quarantine": workforce(lambda m: all_broken_rows(workforce_checks.row_rules(m)), share=True),
    "freshness_report": _freshness,
}

ANALYSIS = {
    "rh_row_counts": shared_ride(
        lambda m: row_counts(_named(m, "int_trips_enriched", "int_driver_metrics", "int_rider_activity") | m.marts())
    ),
    "hr_row_counts": workforce(
        lambda m: row_counts(
            _named(m, "stg_employees", "stg_payroll", "stg_performance_reviews", "stg_departments")
        )
    ),
    "rh_bridge_components": ride(lambda m: ride_finance.bridge_components(m.int_trips_enriched)),
    "rh_incentive_recon_detail": ride(
        lambda m: ride_drivers.ledger_comparison(m.mart_drivers, m.raw.driver_incentives)
    ),
    "rh_active_rider_counts": ride(lambda m: ride_riders.active_rider_counts(m.mart_riders)),
    "hr_person_summary": workforce(lambda m: people_history.person_summary(m.int_person_employment_history)),
    "hr_workforce_summary": workforce(
        lambda m: people_history.person_summary(m.fct_workforce).drop("has_transferred")
    ),
    "hr_record_type_counts": workforce(lambda m: people_history.record_type_counts(m.stint_records)),
    "hr_active_headcount": workforce(
        lambda m: m.int_person_employment_history.where("is_currently_active = 1").agg(
            F.count("*").alias("active_headcount")
        )
    ),
    "hr_dept_total": workforce(lambda m: m.dim_department.agg(F.sum("active_headcount").alias("total_active"))),
    "hr_latest_attrition": workforce(_latest_attrition),
}

EXTENSIONS = {
    "hr_inferred_termination": workforce(
        lambda m: people_staging.inferred_terminations(m.stg_employees, m.raw.payroll)
    ),
    "hr_inferred_workforce_kpis": workforce(lambda m: m.workforce_kpis, infer_terminations=True),
    "hr_payroll_reassigned": workforce(
        lambda m: people_staging.reassigned_payroll(
            m.stg_payroll, people_staging.dropped_records(m.raw.employees), m.stg_employees
        )
    ),
    "hr_payroll_cancelled": workforce(lambda m: people_staging.cancelled_payroll(m.raw.payroll)),
    "hr_payroll_reissued": workforce(
        lambda m: people_staging.payroll(m.raw.payroll).where("has_reissued_payroll").drop("is_cancelled_run")
    ),
    "hr_dedup_audit": workforce(
        lambda m: people_staging.dedup_audit(m.raw.employees, m.raw.performance_reviews)
    ),
    "hr_department_movements": workforce(
        lambda m: people_departments.department_movements(
            m.stint_records, m.int_person_employment_history, m.stg_departments
        )
    ),
    "hr_attrition_standard": workforce(
        lambda m: people_attrition.attrition_standard(m.stint_spans, m.as_of)
    ),
    "hr_inferred_transfers": workforce(lambda m: people_transfers.inferred_transfers(m.stg_employees)),
    "hr_transfer_backtest": workforce(lambda m: people_transfers.backtest(m.stg_employees)),
    "hr_relinked_stints": workforce(_relinked_stints, infer_transfers=True),
    "hr_payroll_cost_tieout": workforce(_tieout),
    "hr_pay_employment_gaps": workforce(lambda m: _pay_gaps(m)[1]),
    "hr_pay_gaps_as_paid": workforce(lambda m: _pay_gaps(m, reassign=False)[1]),
    "hr_tenure_bridged": workforce(
        lambda m: people_service.tenure_bridged(m.stint_spans, m.int_person_employment_history, m.as_of)
    ),
    "hr_payroll_monthly_cost": _payroll_monthly_cost,
    "hr_tenure_spread_bridge": workforce(
        lambda m: people_bridge.tenure_spread_bridge(
            m.stint_records, m.stint_spans, m.int_person_employment_history, m.as_of
        )
    ),
    "hr_duplicate_bridge": workforce(
        lambda m: people_bridge.duplicate_bridge(
            m.raw.employees, people_staging.dropped_records(m.raw.employees), m.stg_employees
        )
    ),
    "hr_tenure_by_department": workforce(
        lambda m: people_departments.tenure_by_department(m.int_person_employment_history, m.stg_departments)
    ),
    "rh_failed_attempts": ride(lambda m: ride_audits.failed_attempts_with_outcome(m.raw.payments)),
    "rh_retry_rates": ride(lambda m: ride_audits.retry_rates(m.raw.payments)),
    "rh_multi_campaign_pct": ride(lambda m: ride_finance.multi_campaign_share(m.int_trips_enriched)),
    "rh_campaign_overlap": ride(lambda m: ride_campaigns.campaign_overlap(m.raw.driver_incentives, m.stg_trips)),
    "rh_kpis_by_capture_month": ride(
        lambda m: ride_finance.kpis_by_cash_month(m.int_trips_enriched, m.raw.driver_incentives)
    ),
    "rh_trip_distance": ride(lambda m: ride_distance.trip_distances(m.located_trips)),
    "rh_surge_by_distance": ride(
        lambda m: ride_distance.surge_by_distance(
            ride_distance.trip_distances(m.located_trips)
        )
    ),
    "rh_eta_bands": ride(lambda m: ride_eta.eta_bands(durable(ride_eta.eta_sketch(m.stg_trips), "eta"))),
    "rh_clock_skew": ride(lambda m: ride_audits.clock_skew(m.stg_trips)),
    "rh_cash_ledger_tieout": ride(
        lambda m: ride_finance.cash_ledger_tieout(m.stg_trips, m.stg_payments)
    ),
    "rh_contribution_bridge": ride(
        lambda m: ride_finance.contribution_bridge(
            m.int_trips_enriched, m.stg_payments, m.raw.payments, ride_audits.extra_captures(m.raw.payments)
        )
    ),
    "rh_kpis_at_monthly_rate": _kpis_at_monthly_rate,
    "rh_bridge_residual": ride(lambda m: ride_finance.closing_bridge(m.int_trips_enriched)),
    "rh_dedup_audit": ride(lambda m: ride_audits.dedup_audit(m.raw.drivers, m.raw.payments)),
    "rh_period_restatement": _period_restatement,
    "rh_changed_months": _changed_months,
    "rh_trips_by_month": lambda spark, folder: present(_refreshed(spark, folder)[1].drop(refresh.PARTITION)),
    "fx_daily_rates": lambda spark, folder: present(_daily_rates(spark, folder)),
    "fx_monthly_rates": lambda spark, folder: present(fx_rates.monthly_rates(_daily_rates(spark, folder))),
    "fx_asof_rates": _fx_as_of,
    "fx_daily_rates_merged": _merged_rates,
    "fx_asof_moment": _fx_at_moment,
}

QUERIES: dict[str, Query] = {**RIDE_MODELS, **WORKFORCE_MODELS, **QUALITY, **ANALYSIS, **EXTENSIONS}
