"""Successors of transferred records that no record names as its predecessor.

The departures and arrivals of a person without a link are put in order of time. Mutual choice of the nearest,
round after round, pairs them like brackets: an arrival closes the last departure that is still open. So
the depth of every event, a running sum, gives all rounds at once, without a pair of candidates being formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The longest way from a departure to its successor's first day, and the longest that needs no second look.
MAX_DAYS, REVIEW_DAYS = 90, 14


def _unlinked(employees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transferred records that nobody follows, and records that follow no known one."""
    named = employees.where("prior_employee_id is not null")
    followed = named.select(F.col("prior_employee_id").alias("employee_id"))
    departures = employees.where("employment_status = 'transferred'").join(followed, "employee_id", "left_anti")
    known = employees.select(F.col("employee_id").alias("prior_employee_id"))
    # Records without a predecessor are most of them; they need no lookup.
    arrivals = employees.where("prior_employee_id is null").unionByName(
        named.join(known, "prior_employee_id", "left_anti").select(employees.columns)
    )
    return departures, arrivals


def inferred_transfers(employees: DataFrame, max_days: int = MAX_DAYS, review_days: int = REVIEW_DAYS) -> DataFrame:
    """One row per transferred record without a successor: the record that most likely is it, if any, and the days between.

    A successor belongs to the same person and begins on the day of the transfer or within ``max_days`` after;
    nobody is given two. Of departures on one day the highest employee_id comes last and is closed first; of
    arrivals on one day the lowest closes first. Records without a person or an end, or that end on the day they
    began or before, get none. ``needs_review`` marks those without a successor and those further than ``review_days``.
    Persons without such a departure take no part, so the windows hold the loose ends of few persons.
    """
    departures, arrivals = _unlinked(employees)
    ends = departures.where("person_id is not null and termination_date > hire_date").select(
        "person_id", "employee_id", F.col("termination_date").alias("day"), F.lit(0).alias("kind")
    )
    starts = arrivals.where("hire_date is not null").join(ends.select("person_id"), "person_id", "left_semi")
    events = ends.unionByName(starts.select("person_id", "employee_id", F.col("hire_date").alias("day"), F.lit(1).alias("kind")))
    along = W.partitionBy("person_id").orderBy("day", "kind", "employee_id").rowsBetween(W.unboundedPreceding, 0)
    at_depth = W.partitionBy("person_id", "depth").orderBy("day", "kind", "employee_id")
    following = F.lead(F.struct("kind", "employee_id", "day")).over(at_depth)
    paired = (
        events.withColumn("open", F.sum(F.expr("if(kind = 0, 1, -1)")).over(along))
        .withColumn("floor", F.least(F.lit(0), F.min("open").over(along)))
        .withColumn("depth", F.col("open") - F.col("floor") + F.col("kind"))
        .withColumn("next", following)
        .where(f"kind = 0 and next.kind = 1 and date_diff(next.day, day) <= {max_days}")
        .select("employee_id", F.col("next.employee_id").alias("successor_id"), F.col("next.day").alias("hired_on"))
    )
    return (
        departures.select("employee_id", "person_id", F.col("termination_date").alias("transferred_on"))
        .join(paired, "employee_id", "left")
        .withColumn("distance_days", F.date_diff("hired_on", "transferred_on"))
        .withColumn("needs_review", F.coalesce(F.col("distance_days") > review_days, F.lit(True)))
    )


def with_inferred_links(employees: DataFrame, inferred: DataFrame) -> DataFrame:
    """The records, each inferred successor naming its predecessor."""
    links = inferred.where("successor_id is not null").select(
        F.col("successor_id").alias("employee_id"), F.col("employee_id").alias("inferred_prior")
    )
    prior = F.coalesce("inferred_prior", "prior_employee_id").alias("prior_employee_id")
    joined = employees.join(links, "employee_id", "left")
    return joined.select(*[prior if name == "prior_employee_id" else name for name in employees.columns])


def without_transfer_links(employees: DataFrame) -> DataFrame:
    """The records as if nobody had noted which transferred record they follow."""
    before = employees.where("employment_status = 'transferred'").select(
        F.col("employee_id").alias("prior_employee_id"), F.lit(True).alias("after_transfer")
    )
    named = employees.where("prior_employee_id is not null").join(before, "prior_employee_id", "left")
    kept = F.when(F.col("after_transfer").isNull(), F.col("prior_employee_id")).alias("prior_employee_id")
    blanked = named.select(*[kept if name == "prior_employee_id" else name for name in employees.columns])
    return employees.where("prior_employee_id is null").unionByName(blanked)


def backtest(employees: DataFrame, max_days: int = MAX_DAYS, review_days: int = REVIEW_DAYS) -> DataFrame:
    """How inference would do on the transfers whose successors are known, by outcome: ``found`` the noted successor,
    ``other`` for another one, ``missed`` none, ``invented`` one for a record without a noted successor, and ``none`` for
    neither. A record that several name counts once per name."""
    inferred = inferred_transfers(without_transfer_links(employees), max_days, review_days)
    noted = employees.where("prior_employee_id is not null").select(
        F.col("prior_employee_id").alias("employee_id"), F.col("employee_id").alias("noted_id")
    )
    outcome = F.expr(
        """case when noted_id = successor_id then 'found' when noted_id is null and successor_id is null then 'none'
                when noted_id is null then 'invented' when successor_id is null then 'missed' else 'other' end"""
    )
    return (
        inferred.join(noted, "employee_id", "left")
        .groupBy(outcome.alias("outcome"))
        .agg(
            F.count("*").alias("transfers"),
            F.count_if("needs_review").alias("to_review"),
            F.max("distance_days").cast("bigint").alias("max_distance_days"),
        )
    )
