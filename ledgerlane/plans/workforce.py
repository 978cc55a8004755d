"""Workforce models from raw tables to marts."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame

from ledgerlane.functions.durable import durable
from ledgerlane.operators import (
    people_attrition,
    people_bridge,
    people_history,
    people_staging,
    people_stints,
    people_transfers,
)
from ledgerlane.sources.tables import WorkforceTables

DEFAULT_AS_OF = date(2025, 12, 31)


class WorkforceModels:
    """Models over one set of raw tables, measured at ``as_of``.

    Tables that one model reads several times are written once per object: staged employees,
    because following transfers reads them repeatedly, and stint records and spans where needed.
    ``share`` makes every model use those copies, for building several from one object. ``bucketed`` raw tables
    are stored by their keys already (``save_bucketed_tables``), so none is dealt out.
    """

    def __init__(
        self,
        raw: WorkforceTables,
        as_of: date = DEFAULT_AS_OF,
        infer_terminations: bool = False,
        share: bool = False,
        infer_transfers: bool = False,
        bucketed: bool = False,
    ):
        self.raw = raw
        self.as_of = as_of
        self.infer_terminations = infer_terminations
        self.share = share
        self.infer_transfers = infer_transfers
        self.bucketed = bucketed

    @cached_property
    def stg_departments(self) -> DataFrame:
        return people_staging.departments(self.raw.departments)

    @cached_property
    def stg_employees(self) -> DataFrame:
        return people_staging.employees(self.raw.employees)

    @cached_property
    def stg_payroll(self) -> DataFrame:
        return people_staging.payroll(self.raw.payroll, self.bucketed).drop("has_reissued_payroll")

    @cached_property
    def stg_performance_reviews(self) -> DataFrame:
        return people_staging.performance_reviews(self.raw.performance_reviews)

    @cached_property
    def _employees(self) -> DataFrame:
        staged = self.stg_employees
        if self.infer_terminations:
            inferred = people_staging.inferred_terminations(staged, self.raw.payroll)
            staged = people_staging.with_inferred_terminations(staged, inferred)
        if self.infer_transfers:
            staged = people_transfers.with_inferred_links(staged, people_transfers.inferred_transfers(staged))
        return durable(staged, "employees")

    @cached_property
    def _placed_records(self) -> DataFrame:
        placement = people_stints.stint_placement(self._employees)
        return people_stints.stint_records(self._employees, placement)

    @cached_property
    def stint_records(self) -> DataFrame:
        return durable(self._placed_records, "stint-records")

    @cached_property
    def stint_spans(self) -> DataFrame:
        return durable(self._spans_view(), "stint-spans")

    def _spans_view(self) -> DataFrame:
        """Spans from the written records if there are any, otherwise straight from the feed."""
        written = self.share or "stint_records" in self.__dict__
        return people_stints.stint_spans(self.stint_records if written else self._placed_records)

    @cached_property
    def int_employment_stints(self) -> DataFrame:
        records = self.stint_records
        return people_stints.employment_stints(records, self.stint_spans)

    @cached_property
    def int_payroll_monthly(self) -> DataFrame:
        return people_staging.payroll_monthly(self.stg_payroll, self.stg_employees)

    @cached_property
    def int_person_employment_history(self) -> DataFrame:
        spans = self.stint_spans if self.share else self._spans_view()
        return people_history.person_history(spans, self.as_of)

    @cached_property
    def dim_department(self) -> DataFrame:
        return people_history.department_dimension(self.stg_departments, self.int_person_employment_history)

    @cached_property
    def fct_workforce(self) -> DataFrame:
        return people_history.workforce_fact(
            self.int_person_employment_history,
            self.stg_departments,
            self._employees,
            self.raw.payroll,
            self.raw.performance_reviews,
        )

    @cached_property
    def fct_attrition_monthly(self) -> DataFrame:
        return people_attrition.attrition_monthly(self.stint_spans, self.as_of)

    @cached_property
    def rpt_reconciliation_bridge(self) -> DataFrame:
        return people_bridge.attrition_bridge(self.stint_records)

    @cached_property
    def workforce_kpis(self) -> DataFrame:
        records = self.stint_records
        return people_bridge.workforce_kpis(records, self.int_person_employment_history)

    def settle(self, names: Iterable[str]) -> None:
        """Write these models and use the written copies from now on."""
        for name in names:
            self.__dict__[name] = durable(getattr(self, name), name)

    def marts(self) -> dict[str, DataFrame]:
        return {
            name: getattr(self, name)
            for name in (
                "dim_department",
                "fct_workforce",
                "fct_attrition_monthly",
                "rpt_reconciliation_bridge",
                "workforce_kpis",
            )
        }
