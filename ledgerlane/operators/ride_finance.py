"""Marketplace KPIs and the bridge from gross merchandise value to net revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.columns import (
    count_where,
    exact_ratio,
    month_of,
    ratio,
    ratio_or_zero,
    ride_usd_rate,
    sum_usd,
)

_NET = "captured_amount_usd - processor_fee_usd"
_UNCOLLECTED = "is_revenue_eligible and not has_captured_payment"
_COLLECTED = "is_revenue_eligible and has_captured_payment"


def _totals(grouped, measures: dict[str, Column]) -> DataFrame:
    return grouped.agg(*[column.alias(name) for name, column in measures.items()])


def _active_people(staged: DataFrame) -> DataFrame:
    """Riders who asked for a trip and drivers who completed one, per month of the request.

    Distinct (month, rider) and (month, driver) pairs are counted; two distinct counts in one
    aggregate would expand every trip. The staged trips have all that is needed.
    """
    month = month_of("requested_at").alias("report_month")
    kinds = {"active_riders": F.col("rider_id"), "active_drivers": F.expr("if(is_completed, driver_id, null)")}
    counted = [
        staged.select(month, person.alias("person"))
        .distinct()
        .groupBy("report_month")
        .agg(F.count("person").alias(name))
        for name, person in kinds.items()
    ]
    return counted[0].unionByName(counted[1], allowMissingColumns=True)


def marketplace_kpis(trips: DataFrame, staged: DataFrame) -> DataFrame:
    """One row per month of the trip request, in dollars."""
    figures = _totals(
        trips.groupBy(month_of("requested_at").alias("report_month")),
        {
            "gmv_usd": sum_usd("gross_fare_usd", "is_completed"),
            "cancellation_fee_revenue_usd": sum_usd("captured_amount_usd", "has_cancellation_fee"),
            "net_revenue_usd": sum_usd(_NET, "is_revenue_eligible"),
            "fraud_revenue_usd": sum_usd("captured_amount_usd", "is_fraud_flagged"),
            "uncollected_fare_usd": sum_usd("gross_fare_usd", _UNCOLLECTED),
            "processor_fees_usd": sum_usd("processor_fee_usd", "is_revenue_eligible"),
            "incentive_spend_usd": sum_usd("incentive_amount_usd"),
            "total_trip_requests": F.count("*"),
            "completed_trips": count_where("is_completed"),
            "cancelled_trips": count_where("trip_status = 'cancelled'"),
            "fraud_trips": count_where("is_fraud_flagged"),
            "revenue_eligible_trips": count_where("is_revenue_eligible"),
        },
    )
    # A handful of rows per month: figures, riders and drivers come together by month, null months too.
    together = figures.unionByName(_active_people(staged), allowMissingColumns=True)
    monthly = together.groupBy("report_month").agg(
        *[F.max(name).alias(name) for name in together.columns if name != "report_month"]
    )
    return monthly.withColumns(
        {
            "gross_revenue_usd": F.expr("gmv_usd + cancellation_fee_revenue_usd"),
            "cancellation_rate": ratio("cancelled_trips", "total_trip_requests", 4),
            "fraud_rate": ratio("fraud_trips", "completed_trips", 4),
            "take_rate": ratio_or_zero("net_revenue_usd", "gmv_usd", 4),
        }
    ).orderBy("report_month")


def revenue_bridge(trips: DataFrame) -> DataFrame:
    """One row that walks from gross merchandise value to net collected revenue."""
    totals = _totals(
        trips,
        {
            "gmv_usd": sum_usd("gross_fare_usd", "is_completed"),
            "cancellation_fee_revenue_usd": sum_usd("captured_amount_usd", "has_cancellation_fee"),
            "fraud_reversals_usd": sum_usd("captured_amount_usd", "is_fraud_flagged and has_captured_payment"),
            "uncollected_fares_usd": sum_usd("gross_fare_usd", _UNCOLLECTED),
            "processor_fees_usd": sum_usd("processor_fee_usd", _COLLECTED),
            "net_revenue_usd": sum_usd(_NET, _COLLECTED),
            "total_incentive_spend_usd": sum_usd("incentive_amount_usd"),
            "incentive_on_fraud_usd": sum_usd("incentive_amount_usd", "is_fraud_flagged"),
        },
    )
    return totals.selectExpr(
        "*", "gmv_usd + cancellation_fee_revenue_usd as gross_revenue_usd", "gmv_usd - net_revenue_usd as total_gap_usd"
    ).withColumns(
        {
            "fraud_pct_of_gap": exact_ratio("fraud_reversals_usd", "total_gap_usd", 4),
            "uncollected_pct_of_gap": exact_ratio("uncollected_fares_usd", "total_gap_usd", 4),
            "fees_pct_of_gap": exact_ratio("processor_fees_usd", "total_gap_usd", 4),
            "gap_rate": exact_ratio("total_gap_usd", "gmv_usd", 4),
        }
    )


def bridge_components(trips: DataFrame) -> DataFrame:
    return _totals(
        trips,
        {
            "gmv_usd": sum_usd("gross_fare_usd", "is_completed"),
            "revenue_captured_usd": sum_usd("captured_amount_usd", "is_revenue_eligible"),
            "fees_usd": sum_usd("processor_fee_usd", "is_revenue_eligible"),
            "fraud_captured_usd": sum_usd("captured_amount_usd", "is_fraud_flagged"),
            "total_incentives_usd": sum_usd("incentive_amount_usd"),
        },
    )


def closing_bridge(trips: DataFrame) -> DataFrame:
    """The gap as lines that sum to it exactly, ending in the unexplained residual.

    Beyond the three headline lines this states fraud fares that were never captured, and fares
    captured at another amount than quoted; without them the bridge does not close.
    """
    totals = _totals(
        trips,
        {
            "gmv": sum_usd("gross_fare_usd", "is_completed"),
            "net": sum_usd(_NET, _COLLECTED),
            "fraud_captured": sum_usd(
                "captured_amount_usd", "is_completed and is_fraud_flagged and has_captured_payment"
            ),
            "fraud_uncollected": sum_usd(
                "gross_fare_usd", "is_completed and is_fraud_flagged and not has_captured_payment"
            ),
            "uncollected": sum_usd("gross_fare_usd", _UNCOLLECTED),
            "fees": sum_usd("processor_fee_usd", _COLLECTED),
            "repriced": sum_usd("gross_fare_usd - captured_amount_usd", "is_completed and has_captured_payment"),
        },
    ).selectExpr("*", "gmv - net as gap")
    lines = [
        ("Gross merchandise value", "gmv"),
        ("Less: fraud captured then reversed", "-fraud_captured"),
        ("Less: fraud fares never captured", "-fraud_uncollected"),
        ("Less: eligible fares never captured", "-uncollected"),
        ("Less: processor fees", "-fees"),
        ("Less: captured below the quoted fare", "-repriced"),
        ("Unexplained residual", "fraud_captured + fraud_uncollected + uncollected + fees + repriced - gap"),
        ("Net collected revenue", "net"),
    ]
    rows = ", ".join(
        f"struct({i} as line_no, '{label}' as line_item, cast({amount} as decimal(38,4)) as amount_usd)"
        for i, (label, amount) in enumerate(lines, start=1)
    )
    share = exact_ratio("-amount_usd", "gap", 4)
    return (
        totals.selectExpr("gap", f"inline(array({rows}))")
        .withColumn("pct_of_gap", F.when(F.expr("line_no between 2 and 7"), share))
        .drop("gap")
    )


def cash_ledger_tieout(trips: DataFrame, payments: DataFrame) -> DataFrame:
    """Net revenue rebuilt from captured cash, next to the figure by trip.

    Both sides come from one full join of staged trips and settled payments: the ledger takes every
    payment at its own currency, the mart every eligible trip at the trip's.
    """
    settled = payments.selectExpr(
        "trip_id", "amount", "processor_fee", f"amount * {ride_usd_rate()} as cash", f"processor_fee * {ride_usd_rate()} as fee"
    )
    joined = trips.select(
        "trip_id", "currency", "is_revenue_eligible", "is_completed", "is_fraud_flagged", "has_cancellation_fee"
    ).join(settled, "trip_id", "full")
    return _totals(
        joined,
        {
            "captured_cash_usd": sum_usd("cash"),
            "fraud_cash_usd": sum_usd("cash", "is_completed and is_fraud_flagged"),
            "cancellation_fee_cash_usd": sum_usd("cash", "has_cancellation_fee"),
            "processor_fees_usd": sum_usd("fee", "is_revenue_eligible"),
            "mart_net_revenue_usd": sum_usd(
                f"(coalesce(amount, 0) - coalesce(processor_fee, 0)) * {ride_usd_rate()}", "is_revenue_eligible"
            ),
        },
    ).selectExpr(
        "*",
        "captured_cash_usd - fraud_cash_usd - cancellation_fee_cash_usd - processor_fees_usd as ledger_net_revenue_usd",
    ).selectExpr(
        "*",
        "ledger_net_revenue_usd - mart_net_revenue_usd as difference_usd",
        "abs(ledger_net_revenue_usd - mart_net_revenue_usd) <= 0.01 as ties_out",
    )


def kpis_by_cash_month(trips: DataFrame, incentives: DataFrame) -> DataFrame:
    """Revenue in the month it was captured and incentives in the month they were paid."""
    earned = _totals(
        trips.where("has_captured_payment").groupBy(month_of("captured_at").alias("cash_month")),
        {
            "captures": F.count("*"),
            "captured_usd": sum_usd("captured_amount_usd"),
            "net_revenue_usd": sum_usd(_NET, "is_revenue_eligible"),
            "cancellation_fee_revenue_usd": sum_usd("captured_amount_usd", "has_cancellation_fee"),
            "fraud_captured_usd": sum_usd("captured_amount_usd", "is_fraud_flagged"),
        },
    )
    paid = _totals(
        incentives.groupBy(month_of("paid_at").alias("cash_month")),
        {
            "incentive_lines_paid": F.count("*"),
            "incentives_paid_usd": F.expr(f"sum(bonus_amount * {ride_usd_rate()})"),
        },
    )
    joined = earned.join(paid, "cash_month", "full")
    return joined.selectExpr(
        "cash_month", *[f"coalesce({name}, 0) as {name}" for name in joined.columns if name != "cash_month"]
    )


def multi_campaign_share(trips: DataFrame) -> DataFrame:
    """Share of incentivised trips that drew bonuses from more than one campaign line."""
    monthly = _totals(
        trips.where("incentive_line_count > 0").groupBy(month_of("requested_at").alias("report_month")),
        {
            "incentivized_trips": F.count("*"),
            "multi_campaign_trips": count_where("is_multi_campaign_trip"),
            "incentive_spend_usd": sum_usd("incentive_amount_usd"),
            "multi_campaign_spend_usd": sum_usd("incentive_amount_usd", "is_multi_campaign_trip"),
        },
    )
    return monthly.withColumn(
        "pct_trips_multi_campaign", ratio("multi_campaign_trips", "incentivized_trips", 4)
    )


def kpis_at_monthly_rate(trips: DataFrame, monthly: DataFrame) -> DataFrame:
    """KPIs per month and currency: local amounts, and dollars at the month's average rate.

    Dollars need no rate. Any other currency without a quote has null dollars.
    """
    local = _totals(
        trips.groupBy(month_of("requested_at").alias("report_month"), "currency"),
        {
            "completed_trips": count_where("is_completed"),
            "gmv_local": sum_usd("gross_fare", "is_completed"),
            "captured_local": sum_usd("captured_amount"),
            "processor_fees_local": sum_usd("processor_fee", "is_revenue_eligible"),
            "net_revenue_local": sum_usd("captured_amount - processor_fee", "is_revenue_eligible"),
            "incentives_local": sum_usd("incentive_amount"),
        },
    )
    rates = monthly.select(F.col("rate_month").alias("report_month"), "currency", "avg_usd_rate")
    priced = local.join(rates, ["report_month", "currency"], "left").withColumn(
        "avg_usd_rate", F.expr("if(currency = 'USD', 1.0D, avg_usd_rate)")
    )
    return priced.withColumns(
        {
            f"{name}_usd": F.expr(f"round(cast({name}_local as double) * avg_usd_rate, 2)")
            for name in ("gmv", "captured", "processor_fees", "net_revenue", "incentives")
        }
    )


def contribution_bridge(
    trips: DataFrame, payments: DataFrame, raw_payments: DataFrame, extra_captures: DataFrame
) -> DataFrame:
    """From gross merchandise value to what is left after incentives, and to the processor's cash.

    Continues ``closing_bridge``: net collected revenue less incentives is the contribution. Net
    revenue plus the fees, fraud captures and cancellation fees in the captured cash is the cash by
    trip. Captures that were logged twice and captures of trips that nobody knows lead from there to
    the sum of the processor's own captures, which is taken from the raw feed at each capture's own
    currency; whatever is left over is the residual.
    """
    usd = f"amount * {ride_usd_rate()}"
    unknown = payments.join(trips.select("trip_id"), "trip_id", "left_anti")
    captured = raw_payments.where("payment_status = 'captured'")

    def total(df: DataFrame, value: str) -> Column:
        return F.coalesce(df.agg(F.expr(f"sum({value})")).scalar(), F.lit(0))

    totals = _totals(
        trips,
        {
            "gmv": sum_usd("gross_fare_usd", "is_completed"),
            "net": sum_usd(_NET, _COLLECTED),
            "incentives": sum_usd("incentive_amount_usd"),
            "on_fraud": sum_usd("incentive_amount_usd", "is_fraud_flagged"),
            "fees": sum_usd("processor_fee_usd", _COLLECTED),
            "cash": sum_usd("captured_amount_usd"),
            "eligible_cash": sum_usd("captured_amount_usd", _COLLECTED),
        },
    ).withColumns(
        {
            "twice": total(extra_captures, "excess_usd"),
            "stray": total(unknown, usd),
            "reported": total(captured, usd),
        }
    )
    by_trip = "net + fees + cash - eligible_cash"
    lines = [
        ("Gross merchandise value", "gmv"),
        ("Less: gap to net collected revenue", "net - gmv"),
        ("Net collected revenue", "net"),
        ("Less: incentives on sound trips", "on_fraud - incentives"),
        ("Less: incentives on fraud trips", "-on_fraud"),
        ("Contribution after incentives", "net - incentives"),
        ("Add back: incentives", "incentives"),
        ("Add back: processor fees", "fees"),
        ("Add: cash that is not revenue (fraud and cancellation fees)", "cash - eligible_cash"),
        ("Captured cash, each trip once", by_trip),
        ("Add: duplicate captures", "twice"),
        ("Add: captures of unknown trips", "stray"),
        ("Unexplained residual", f"reported - ({by_trip}) - twice - stray"),
        ("Cash as the processor reports it", "reported"),
    ]
    rows = ", ".join(
        f"struct({i} as line_no, '{label}' as line_item, cast({amount} as decimal(38,4)) as amount_usd)"
        for i, (label, amount) in enumerate(lines, start=1)
    )
    return totals.selectExpr(f"inline(array({rows}))")
