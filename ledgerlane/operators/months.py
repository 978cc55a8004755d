"""Content of a feed by calendar month, without regard to the order of its rows.

A month is 'yyyy-MM'; rows without a time, or with a year outside 1 to 9999, are the month 'none'.
"""

from __future__ import annotations

import calendar
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import row_hashes

NO_MONTH = "none"
#: What rows that name no known trip reach.
NO_TRIP = "no trip"


def _month_number(at: str) -> Column:
    """The month as one number, which rows are grouped by faster than by text; null for 'none'."""
    return F.expr(f"if(year({at}) between 1 and 9999, year({at}) * 12 + month({at}) - 1, null)")


def _month_text(number: str) -> Column:
    return F.expr(f"if({number} is null, '{NO_MONTH}', format_string('%04d-%02d', {number} div 12, {number} % 12 + 1))")


def month_key(at: str) -> Column:
    return F.expr(f"if(year({at}) between 1 and 9999, date_format({at}, 'yyyy-MM'), '{NO_MONTH}')")


def in_months(at: str, months: Iterable[str]) -> Column:
    """Rows of these months, as ranges of time that reach the Parquet scan; neighbouring months are one range."""
    numbers = sorted(int(m[:4]) * 12 + int(m[5:]) - 1 for m in months if m != NO_MONTH)
    ranges: list[list[int]] = []
    for n in numbers:
        if ranges and ranges[-1][1] == n - 1:
            ranges[-1][1] = n
        else:
            ranges.append([n, n])

    def start(n: int) -> str:
        return f"timestamp_ntz'{n // 12:04d}-{n % 12 + 1:02d}-01 00:00:00'"

    def end(n: int) -> str:
        last = calendar.monthrange(n // 12, n % 12 + 1)[1]
        return f"timestamp_ntz'{n // 12:04d}-{n % 12 + 1:02d}-{last} 23:59:59.999999'"

    parts = [f"({at} >= {start(a)} and {at} <= {end(b)})" for a, b in ranges]
    if NO_MONTH in months:
        parts.append(f"{at} is null or year({at}) not between 1 and 9999")
    return F.expr(" or ".join(parts) or "false")


def fingerprints(feed: DataFrame, at: str) -> DataFrame:
    """One row per month: its rows and two exact sums of 64-bit row hashes. Equal content gives equal sums in any order
    and any division into files; repeats count. One hash aggregate, as many rows as months.

    A hash is added up in three parts of at most 22 bits, whose sums stay longs for 2^41 rows of a month, and put together
    per month; adding decimals row by row takes several times as long."""
    parts = {f"_{i}_{shift}": _part(h, shift) for i, h in enumerate(row_hashes(feed.columns)) for shift in _SHIFTS}
    added = (
        feed.groupBy(_month_number(at).alias("_month"))
        .agg(F.count("*").alias("rows"), *[F.sum(part).alias(name) for name, part in parts.items()])
    )
    whole = " + ".join(f"cast(_{{0}}_{shift} as decimal(20,0)) * cast({1 << shift} as decimal(14,0))" for shift in _SHIFTS)
    sums = [F.expr(f"cast(cast({whole.format(i)} as decimal(30,0)) as string) as sum_{i}") for i in (0, 1)]
    return added.select(_month_text("_month").alias("month"), "rows", *sums)


_PART_BITS = 22
_SHIFTS = (0, _PART_BITS, 2 * _PART_BITS)


def _part(whole: Column, shift: int) -> Column:
    """The bits of a long from ``shift`` on: as many as a part has, and for the last part the rest with the sign."""
    rest = F.shiftright(whole, shift)
    return rest if shift == _SHIFTS[-1] else rest.bitwiseAND((1 << _PART_BITS) - 1)


def reach(feeds: Sequence[tuple[str, DataFrame, str]], trips: DataFrame, requested_at: str) -> DataFrame:
    """Which trip months the rows of each month of feeds (name, rows, time) belong to: (feed, month, trip_month). Rows whose
    trip is unknown reach 'no trip'. Trips and rows are reduced to (trip, month) pairs before they meet, so that a trip with
    very many rows sends one pair per task and month; trips meet the rows of all feeds at once."""
    rows = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("feed"), "trip_id", _month_number(at).alias("_month")) for name, df, at in feeds],
    ).distinct()
    owners = trips.select("trip_id", _month_number(requested_at).alias("_trip_month"), F.lit(True).alias("_known"))
    return (
        rows.join(owners, "trip_id", "left")
        .select("feed", "_month", "_trip_month", "_known")
        .distinct()
        .select(
            "feed",
            _month_text("_month").alias("month"),
            F.when(F.col("_known"), _month_text("_trip_month")).otherwise(NO_TRIP).alias("trip_month"),
        )
    )
