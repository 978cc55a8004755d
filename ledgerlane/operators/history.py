"""What changed between two runs: keyed differences, versions with validity ranges, and restated periods."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlane.functions.columns import month_of, row_hashes

ADDED, CHANGED, REMOVED = "added", "changed", "removed"


def _row_hash(columns: Sequence[str]) -> Column:
    return F.struct(*row_hashes(columns))


def differences(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that two runs do not share, by key: the columns of ``after`` and ``change``. A removed row has its old
    values. Rows are compared by hash, so only the keys and hashes of the first run meet the rows of the second.
    Keys are unique; null is a key like any other."""
    columns = after.columns
    old = before.select(F.struct(*keys).alias("_key"), _row_hash(columns).alias("_was"), F.struct(*columns).alias("_old"))
    new = after.select(F.struct(*keys).alias("_key"), _row_hash(columns).alias("_is"), F.struct(*columns).alias("_new"))
    joined = old.alias("o").join(new.alias("n"), F.col("o._key").eqNullSafe(F.col("n._key")), "full")
    change = (
        F.when(F.col("_was").isNull(), ADDED).when(F.col("_is").isNull(), REMOVED).when(F.col("_was") != F.col("_is"), CHANGED)
    )
    return (
        joined.withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(F.coalesce("_new", "_old").alias("_row"), "change")
        .select("_row.*", "change")
    )


def versions(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All versions of all rows from the differences of successive runs (with ``run_at``): valid from the run that wrote
    them until the run that replaced or removed them; the present ones have no ``valid_to``."""
    order = W.partitionBy(*keys).orderBy("run_at")
    return (
        changes.withColumn("valid_to", F.lead("run_at").over(order))
        .where(F.col("change") != REMOVED)
        .withColumnRenamed("run_at", "valid_from")
        .drop("change")
    )


def at_time(all_versions: DataFrame, moment: datetime) -> DataFrame:
    """The rows as they stood at a moment."""
    when = F.lit(moment)
    valid = (F.col("valid_from") <= when) & (F.col("valid_to").isNull() | (F.col("valid_to") > when))
    return all_versions.where(valid).drop("valid_from", "valid_to")


def as_known(trips: DataFrame, payments: DataFrame, incentives: DataFrame, moment: datetime, review_days: int) -> list[DataFrame]:
    """The feeds as they stood at a moment: trips requested, captures settled and incentives earned by then. A fraud
    review takes ``review_days``, so later trips carry no flag yet."""
    now, reviewed = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (moment, moment - timedelta(days=review_days)))
    seen = F.col("requested_at") <= now
    flag = F.col("is_fraud_flagged") & (F.col("requested_at") <= reviewed)
    settled = (F.col("attempted_at") <= now) & (F.col("captured_at").isNull() | (F.col("captured_at") <= now))
    return [
        trips.where(seen).withColumn("is_fraud_flagged", flag),
        payments.where(settled),
        incentives.where(F.col("earned_at") <= now),
    ]


_COMPARED = [
    "requested_at", "is_completed", "is_revenue_eligible", "is_fraud_flagged", "has_captured_payment",
    "has_duplicate_captures", "gross_fare_usd", "captured_amount_usd", "processor_fee_usd", "incentive_amount_usd",
]


def restatement(before: DataFrame, after: DataFrame, closed_at: datetime) -> DataFrame:
    """How the months that a run had covered by ``closed_at`` were restated by a later run, and why.

    Both runs' trip facts meet once, on trip_id. A trip whose figures differ has one cause: it came late or
    went, its fraud flag changed, its capture came late, it was captured twice, its incentives changed, or
    its amounts were amended; the first that applies counts. The changes of a month's causes add up to the
    change of its figures.
    """
    covered = F.col("requested_at") <= F.lit(closed_at.isoformat(sep=" ")).cast("timestamp_ntz")

    def side(trips: DataFrame, name: str) -> DataFrame:
        return trips.where(covered).select("trip_id", F.struct(*_COMPARED).alias(name))

    net = "if({0}.is_revenue_eligible and {0}.has_captured_payment, {0}.captured_amount_usd - {0}.processor_fee_usd, 0)"
    gmv = "if({0}.is_completed, {0}.gross_fare_usd, 0)"
    cause = """case when b is null then 'late_trip' when a is null then 'withdrawn_trip'
                    when not (b.is_fraud_flagged <=> a.is_fraud_flagged) then 'fraud_flag'
                    when not b.has_captured_payment and a.has_captured_payment then 'late_capture'
                    when not b.has_duplicate_captures and a.has_duplicate_captures then 'duplicate_capture'
                    when b.incentive_amount_usd <> a.incentive_amount_usd then 'late_incentive'
                    else 'amended' end"""

    def change(measure: str) -> str:
        return f"coalesce({measure.format('a')}, 0) - coalesce({measure.format('b')}, 0)"

    return (
        side(before, "b")
        .join(side(after, "a"), "trip_id", "full")
        .where("not (a <=> b)")
        .selectExpr(
            "coalesce(a.requested_at, b.requested_at) as requested_at",
            f"{cause} as cause",
            f"{change(gmv)} as gmv",
            f"{change(net)} as net",
            f"{change('{0}.incentive_amount_usd')} as incentives",
        )
        .groupBy(month_of("requested_at").alias("report_month"), "cause")
        .agg(
            F.count("*").alias("trips"),
            F.sum("gmv").alias("gmv_change_usd"),
            F.sum("net").alias("net_revenue_change_usd"),
            F.sum("incentives").alias("incentives_change_usd"),
        )
    )
