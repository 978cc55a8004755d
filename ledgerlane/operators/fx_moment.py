"""The rate that stood at the moment of a trip.

Trips and quotes are merged in time buckets of a currency: within a bucket every trip takes the last quote
before it, and what stood when the bucket began is carried over from a table with one row per bucket. So the
hours of one currency are sorted by as many tasks, and no trip meets more than one quote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlane.functions.columns import month_of

#: Length of a bucket; shorter ones spread a busy hour over more tasks.
BUCKET_MINUTES = 60


def _bucket(at: str, minutes: int) -> Column:
    days = f"date_diff(cast({at} as date), date'1970-01-01')"
    return F.expr(f"cast(floor(({days} * 1440L + hour({at}) * 60 + minute({at})) / {minutes}) as bigint)")


def _carried(trips: DataFrame, quotes: DataFrame) -> DataFrame:
    """Per currency and bucket with a trip: the last quote of earlier buckets, and the currency's first quote. The window
    runs over one row per bucket, so its length is that of the calendar, whatever the numbers of trips and quotes."""
    sides = (
        quotes.groupBy("currency", "bucket").agg(F.min("quote").alias("opening"), F.max("quote").alias("closing")).withColumn("asked", F.lit(False))
    )
    empty = F.lit(None).cast(sides.schema["opening"].dataType)
    asked = trips.select("currency", "bucket").distinct().select("currency", "bucket", empty.alias("opening"), empty.alias("closing"), F.lit(True).alias("asked"))
    order = W.partitionBy("currency").orderBy("bucket")
    earlier = order.rangeBetween(W.unboundedPreceding, -1)
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return (
        sides.union(asked)
        .withColumn("carried", F.last("closing", ignorenulls=True).over(earlier))
        .withColumn("first_quote", F.first("opening", ignorenulls=True).over(everything))
        .where("asked")
        .select("currency", "bucket", "carried", "first_quote")
    )


def rates_at_moment(trips: DataFrame, quotes: DataFrame, at: str = "requested_at", bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """The trips with ``moment_rate``, ``rate_quoted_at`` and ``is_filled_back``.

    Quotes have columns currency, quoted_at, quote_id, usd_rate; a quote counts from its own moment on, and
    the highest quote_id of several at one moment. Trips before the first quote of their currency take it
    back. Trips without a moment or currency, and currencies without a quote, have no rate. Quotes that lack
    a currency, moment or rate do not count.
    """
    own = trips.columns
    quoted = quotes.where("currency is not null and quoted_at is not null and usd_rate is not null").select(
        "currency", _bucket("quoted_at", bucket_minutes).alias("bucket"), F.struct("quoted_at", "quote_id", "usd_rate").alias("quote")
    )
    datable = f"{at} is not null and currency is not null"
    asked = trips.where(datable).select("currency", _bucket(at, bucket_minutes).alias("bucket"), F.col(at).alias("at"), F.struct(*own).alias("trip"))
    no_quote, no_trip = (F.lit(None).cast(df.schema[name].dataType) for df, name in ((quoted, "quote"), (asked, "trip")))
    events = asked.withColumn("quote", no_quote).unionByName(quoted.withColumns({"at": F.col("quote.quoted_at"), "trip": no_trip}))
    # At one moment quotes come before trips, the highest id last.
    order = W.partitionBy("currency", "bucket").orderBy("at", F.col("trip").isNotNull(), "quote.quote_id")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    merged = events.withColumn("quote", F.last("quote", ignorenulls=True).over(so_far)).where("trip is not null")
    chosen = F.coalesce("quote", "carried", "first_quote")
    priced = merged.join(_carried(asked, quoted), ["currency", "bucket"], "left").select(
        "trip.*",
        chosen["usd_rate"].alias("moment_rate"),
        chosen["quoted_at"].alias("rate_quoted_at"),
        (F.col("quote").isNull() & F.col("carried").isNull() & F.col("first_quote").isNotNull()).alias("is_filled_back"),
    )
    undated = trips.where(f"not ({datable})").select(
        *own,
        F.lit(None).cast(priced.schema["moment_rate"].dataType).alias("moment_rate"),
        F.lit(None).cast(priced.schema["rate_quoted_at"].dataType).alias("rate_quoted_at"),
        F.lit(False).alias("is_filled_back"),
    )
    return priced.unionByName(undated)


def convert_at_moment(trips: DataFrame, quotes: DataFrame, daily: DataFrame, bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Gross fares by month and currency at the rate of the moment, beside those at the rate of the day.

    Dollars need no rate; other trips without one are counted and have no amount.
    """
    slim = trips.select("currency", "requested_at", "gross_fare")
    priced = rates_at_moment(slim, quotes, bucket_minutes=bucket_minutes).withColumn("rate_date", F.expr("cast(requested_at as date)"))
    both = priced.join(daily.select("currency", "rate_date", "usd_rate"), ["currency", "rate_date"], "left").selectExpr(
        "currency", "gross_fare", "rate_date", "requested_at", "rate_quoted_at",
        "is_filled_back and currency <> 'USD' as is_filled_back",
        "if(currency = 'USD', cast(1 as decimal(10,4)), moment_rate) as at_moment",
        "if(currency = 'USD', cast(1 as decimal(10,4)), usd_rate) as on_day",
    )
    return both.groupBy(month_of("rate_date").alias("report_month"), "currency").agg(
        F.count("*").alias("trips"),
        F.sum("gross_fare").alias("gross_local"),
        F.expr("sum(gross_fare * at_moment)").alias("gross_usd_at_moment"),
        F.expr("sum(gross_fare * on_day)").alias("gross_usd_on_day"),
        F.expr("sum(gross_fare * (at_moment - on_day))").alias("difference_usd"),
        F.expr("count_if(at_moment <> on_day)").alias("trips_at_another_rate"),
        F.expr("count_if(cast(rate_quoted_at as date) < rate_date)").alias("trips_on_carried_rate"),
        F.expr("count_if(is_filled_back)").alias("trips_before_first_quote"),
        F.expr("count_if(at_moment is null)").alias("trips_without_rate"),
    )
