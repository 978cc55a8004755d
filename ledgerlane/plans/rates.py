"""Daily rates kept up to date by batches of quotes, in any order.

``out_dir/quotes`` holds the winning quote of every currency and day, partitioned by currency and month, and
``out_dir/daily`` the daily rates, partitioned likewise. A batch is merged into the months of quotes that it names;
then the daily rates, which have one row per currency and day whatever the number of quotes, are derived anew
and the currency-months that differ from the written ones are replaced. So a late correction rewrites the months
that carry its quote and no other, a batch that comes twice changes nothing, and a run that broke half-way is made
good by the next one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.durable import drop_durable, durable
from ledgerlane.functions.files import children
from ledgerlane.operators.fx_rates import daily_rates
from ledgerlane.operators.history import differences

_QUOTES = "quote_id bigint, usd_rate decimal(10,4), quoted_on date, currency string, month string"
_DAILY = "rate_date date, usd_rate decimal(10,4), quoted_on date, currency string, month string"
_PLACE = ["currency", "month"]


@dataclass(frozen=True)
class Merged:
    """The currency-months that a batch rewrote, as (currency, 'yyyy-MM')."""

    quotes: list[tuple[str, str]]
    daily: list[tuple[str, str]]


def _month(day: str):
    return F.date_format(day, "yyyy-MM").alias("month")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    table = spark.read.schema(schema)
    return table.parquet(path) if children(spark, path) else spark.createDataFrame([], schema)


def _replace(df: DataFrame, path: str) -> list[tuple[str, str]]:
    """Overwrite the currency-months that ``df`` holds, no others, and list them."""
    written = durable(df, "rates")
    places = sorted((r.currency, r.month) for r in written.select(*_PLACE).distinct().collect())  # currencies x months
    if places or not children(df.sparkSession, path):
        ordered = written.repartition(*_PLACE).sortWithinPartitions(*_PLACE)
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_PLACE).parquet(path)
    drop_durable(written)
    return places


def stored_quotes(spark: SparkSession, out_dir: str) -> DataFrame:
    return _read(spark, f"{out_dir}/quotes", _QUOTES)


def stored_daily(spark: SparkSession, out_dir: str) -> DataFrame:
    """currency, rate_date, usd_rate, quoted_on, and the month."""
    return _read(spark, f"{out_dir}/daily", _DAILY)


def merge_quotes(batch: DataFrame, out_dir: str, first_day: date, last_day: date) -> Merged:
    """Merge quotes (currency, quoted_on, quote_id, usd_rate; other columns are ignored) and bring the daily rates of
    the calendar up to date. The highest quote_id of a day counts, and of equal ids the higher rate. Days that were
    covered once stay covered: a calendar only grows. Quotes without a currency, day, id or rate do not count."""
    spark = batch.sparkSession
    usable = "currency is not null and quoted_on is not null and quote_id is not null and usd_rate is not null"
    fresh = batch.where(usable).selectExpr(
        "cast(quote_id as bigint) as quote_id", "cast(usd_rate as decimal(10,4)) as usd_rate", "quoted_on", "currency"
    )
    best = F.max(F.struct("quote_id", "usd_rate")).alias("best")
    won = durable(fresh.groupBy("currency", "quoted_on").agg(best), "batch")
    incoming = won.select("best.*", "quoted_on", "currency", _month("quoted_on"))
    kept = stored_quotes(spark, out_dir)
    # A place is rewritten whole if one of its days has a new winner; the others are not touched.
    held = kept.select("currency", "quoted_on", F.struct("quote_id", "usd_rate").alias("held"))
    news = won.join(held, ["currency", "quoted_on"], "left").where("held is null or best > held")
    places = news.select("currency", _month("quoted_on")).distinct()
    united = kept.unionByName(incoming).join(places, _PLACE, "left_semi")
    merged = united.groupBy(*_PLACE, "quoted_on").agg(best).select("best.*", "quoted_on", *_PLACE)
    quotes = _replace(merged, f"{out_dir}/quotes")
    drop_durable(won)
    return Merged(quotes, _bring_up(spark, out_dir, first_day, last_day))


def _bring_up(spark: SparkSession, out_dir: str, first_day: date, last_day: date) -> list[tuple[str, str]]:
    """Replace the currency-months of daily rates that the quotes no longer give."""
    before = stored_daily(spark, out_dir)
    covered = before.agg(F.min("rate_date").alias("a"), F.max("rate_date").alias("b")).first()
    first, last = min(first_day, covered.a or first_day), max(last_day, covered.b or last_day)
    fresh = daily_rates(stored_quotes(spark, out_dir), F.lit(first), F.lit(last))
    after = fresh.select("rate_date", "usd_rate", "quoted_on", "currency", _month("rate_date"))
    changed = differences(before, after, ["currency", "rate_date"]).select(*_PLACE).distinct()
    return _replace(after.join(changed, _PLACE, "left_semi"), f"{out_dir}/daily")


def pull_quotes(feed: DataFrame, out_dir: str, first_day: date, last_day: date) -> Merged:
    """Merge what a feed holds beyond the high-water mark: the highest quote_id merged so far, which is always the winner
    of its day. For feeds that number quotes as they come, whatever days they are for; the mark reaches the scan."""
    mark = stored_quotes(feed.sparkSession, out_dir).agg(F.max("quote_id")).first()[0]
    return merge_quotes(feed if mark is None else feed.where(F.col("quote_id") > mark), out_dir, first_day, last_day)
