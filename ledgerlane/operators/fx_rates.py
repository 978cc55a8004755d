"""Currency rate dimension from irregular quotes, and as-of conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlane.functions.columns import month_of, ratio, ride_usd_rate


def calendar_of(trips: DataFrame) -> tuple[Column, Column]:
    """The days of the first and last trip, as scalar subqueries."""
    day = F.col("requested_at").cast("date")
    return trips.agg(F.min(day)).scalar(), trips.agg(F.max(day)).scalar()


def daily_rates(quotes: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """One rate per currency and calendar day between the two days; none if a day is null.

    Quotes have columns currency, quoted_on, quote_id, usd_rate; the highest quote_id of a day
    counts. A day without a quote carries the last one forward; days before the first quote take
    the first one back. The result has at most currencies x days rows, whatever the quote volume.
    """
    latest = F.max(F.struct("quote_id", "usd_rate"))
    by_day = (
        quotes.where(F.col("quoted_on") <= last_day)
        .groupBy("currency", "quoted_on")
        .agg(latest.alias("quote"))
    )
    along = W.partitionBy("currency").orderBy("quoted_on")
    spans = by_day.select(
        "currency",
        "quoted_on",
        "quote.usd_rate",
        F.when(F.lag("quoted_on").over(along).isNull(), F.least("quoted_on", first_day))
        .otherwise(F.greatest("quoted_on", first_day))
        .alias("starts"),
        F.coalesce(F.date_sub(F.lead("quoted_on").over(along), 1), last_day).alias("ends"),
    ).withColumn("starts", F.greatest("starts", first_day))
    days = F.explode(F.sequence("starts", "ends"))
    return spans.where(F.col("starts") <= F.col("ends")).select(
        "currency",
        days.alias("rate_date"),
        "usd_rate",
        "quoted_on",
    )


def monthly_rates(daily: DataFrame) -> DataFrame:
    """Average of the daily rates, the month-end rate, and how many days had their own quote."""
    return (
        daily.groupBy("currency", month_of("rate_date").alias("rate_month"))
        .agg(
            F.sum("usd_rate").alias("rate_sum"),
            F.count("*").alias("days"),
            F.count_if(F.col("rate_date") == F.col("quoted_on")).alias("quoted_days"),
            F.max(F.struct("rate_date", "usd_rate")).alias("closing"),
        )
        .select(
            "currency",
            "rate_month",
            ratio("rate_sum", "days", 6).alias("avg_usd_rate"),
            F.col("closing.usd_rate").alias("month_end_usd_rate"),
            "days",
            "quoted_days",
        )
    )


def convert_as_of(trips: DataFrame, daily: DataFrame) -> DataFrame:
    """Gross fares by month and currency: local, at the fixed rate, and at the rate of the day.

    The lookup is a plain equality join instead of a range join; Spark broadcasts the rates where
    they are small enough. Dollars need no rate; other trips without a quoted rate are counted and
    have no as-of amount.
    """
    lookup = daily.select(F.col("currency"), F.col("rate_date"), "usd_rate", "quoted_on")
    asked_on = F.col("requested_at").cast("date")
    priced = (
        trips.select("currency", "gross_fare", asked_on.alias("rate_date"))
        .join(lookup, ["currency", "rate_date"], "left")
        .withColumn("rate", F.expr("if(currency = 'USD', cast(1 as decimal(10,4)), usd_rate)"))
    )
    distance = F.abs(F.date_diff(F.col("rate_date"), F.col("quoted_on")))
    return priced.groupBy(month_of("rate_date").alias("report_month"), "currency").agg(
        F.count("*").alias("trips"),
        F.sum("gross_fare").alias("gross_local"),
        F.expr(f"sum(gross_fare * {ride_usd_rate()})").alias("gross_usd_fixed"),
        F.sum(F.col("gross_fare") * F.col("rate")).alias("gross_usd_as_of"),
        F.count_if(F.col("quoted_on") != F.col("rate_date")).alias("trips_on_carried_rate"),
        F.count_if(F.col("rate").isNull()).alias("trips_without_rate"),
        F.coalesce(F.max(distance), F.lit(0)).cast("bigint").alias("max_quote_distance_days"),
    )
