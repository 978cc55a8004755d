"""Stitching employment records into stints.

A transfer closes one record and opens the next, so a stint is a chain of records. Chains are
followed by pointer doubling: every round replaces each record's pointer by its target's
pointer, so a chain of n transfers takes about log2(n) joins over the linked records only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlane.functions.durable import durable
from ledgerlane.functions.groups import number_in_group

TRANSFER = "transfer_continuation"
REHIRE = "rehire_new_stint"
FIRST = "new_stint"


def _links(employees: DataFrame) -> DataFrame:
    """Records that name a predecessor, with a pointer towards the first record of their stint.

    Records without a predecessor need no lookup, which keeps their null keys out of the join.
    """
    before = employees.select(
        F.col("employee_id").alias("prior_employee_id"), F.col("employment_status").alias("prior_status")
    )
    kind = (
        F.when(F.col("prior_status") == "transferred", TRANSFER)
        .when(F.col("prior_status") == "terminated", REHIRE)
        .otherwise(FIRST)
    )
    named = employees.where(F.col("prior_employee_id").isNotNull()).select("employee_id", "prior_employee_id")
    follows = F.col("record_type") == TRANSFER
    return (
        named.join(before, "prior_employee_id", "left")
        .withColumn("record_type", kind)
        .select(
            "employee_id",
            "record_type",
            F.when(follows, F.col("prior_employee_id")).otherwise(F.col("employee_id")).alias("pointer"),
            (~follows).alias("settled"),
        )
    )


def _double(state: DataFrame) -> DataFrame:
    """One round: a pointer to an unlinked record has arrived, any other takes over its target's."""
    target = state.select(
        F.col("employee_id").alias("pointer"),
        F.col("pointer").alias("next_pointer"),
        F.col("settled").alias("next_settled"),
    )
    moved = (
        state.where(~F.col("settled"))
        .join(target, "pointer", "left")
        .select(
            "employee_id",
            "record_type",
            F.coalesce("next_pointer", "pointer").alias("pointer"),
            F.coalesce("next_settled", F.lit(True)).alias("settled"),
        )
    )
    return state.where("settled").unionByName(moved)


def _write_counted(state: DataFrame) -> tuple[DataFrame, int]:
    """The written state and how many of its pointers are still open, counted by the write itself."""
    seen = Observation()
    written = durable(state.observe(seen, F.count_if(~F.col("settled")).alias("open")), "stint-links")
    return written, seen.get["open"]


def stint_placement(employees: DataFrame) -> DataFrame:
    """Record type and first record of the stint for every record that names a predecessor.

    The first record is null for records on a cycle, which no chain ever reaches.
    """
    state, unsettled = _write_counted(_links(employees))
    while unsettled:
        # Two rounds per write settle chains of up to four transfers in one job.
        state, remaining = _write_counted(_double(_double(state)))
        if remaining >= unsettled:
            # A rerun task may have counted twice, so the decision to stop rests on the table.
            remaining = state.where("not settled").count()
            # Every chain that still ends somewhere settles at least one record per round.
            if remaining == unsettled:
                break
        unsettled = remaining
    return state.select(
        "employee_id", "record_type", F.when(F.col("settled"), F.col("pointer")).alias("stint_id")
    )


def stint_records(employees: DataFrame, placement: DataFrame) -> DataFrame:
    """Employment records with their type and stint; records on a cycle belong to none."""
    placed = placement.withColumn("linked", F.lit(True))
    return (
        employees.drop("is_duplicate_record")
        .join(placed, "employee_id", "left")
        .withColumn("record_type", F.coalesce("record_type", F.lit(FIRST)))
        .withColumn("stint_id", F.when(F.col("linked"), F.col("stint_id")).otherwise(F.col("employee_id")))
        .where(F.col("stint_id").isNotNull())
        .drop("linked")
    )


def stint_spans(records: DataFrame) -> DataFrame:
    """One row per stint with its dates, its latest name and its open assignment if any."""
    status = F.col("employment_status")
    is_open = F.coalesce(status == "active", F.lit(False))
    closes = ~is_open & F.coalesce(status != "transferred", F.lit(True))
    assignment = F.struct(
        "hire_date", "employee_id", "department_id", "job_level", "employment_type", "location"
    )
    merged = records.groupBy("stint_id", "person_id").agg(
        F.max_by("full_name", F.struct("hire_date", "employee_id")).alias("full_name"),
        F.min("hire_date").alias("stint_start_date"),
        F.max(F.when(closes, F.col("termination_date"))).alias("last_end"),
        F.max(is_open.cast("int")).alias("is_active_stint"),
        F.count("*").alias("records_in_stint"),
        F.count_if(status == "transferred").alias("transfers_in_stint"),
        F.max(F.when(is_open, assignment)).alias("assignment"),
    )
    return merged.withColumn(
        "stint_end_date", F.when(F.col("is_active_stint") == 0, F.col("last_end"))
    ).drop("last_end")


def employment_stints(records: DataFrame, spans: DataFrame) -> DataFrame:
    """Every employment record with its stint and the stint's number for the person."""
    numbered = number_in_group(
        spans.select(
            "stint_id",
            "person_id",
            "stint_start_date",
            "stint_end_date",
            "is_active_stint",
            "records_in_stint",
            "transfers_in_stint",
        ),
        "person_id",
        "stint_start_date",
        ["stint_id"],
        "stint_number",
    )
    return records.join(numbered, ["stint_id", "person_id"])
