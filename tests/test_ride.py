"""Ride-hailing semantics on small cases."""

from datetime import date, datetime
from decimal import Decimal

from fixtures import ride

from ledgerlane.operators import fx_rates, ride_audits, ride_campaigns, ride_distance, ride_finance, ride_staging
from ledgerlane.sources.tables import RIDE_SCHEMAS, conform


def trips(spark, rows):
    names = "trip_id long, trip_status string, cancel_reason string, is_fraud_flagged boolean"
    return spark.createDataFrame(rows, names)


def test_trip_classes_follow_three_valued_logic(spark):
    rows = [
        (1, "completed", None, False),
        (2, "completed", None, True),
        (3, "completed", None, None),
        (4, "cancelled", "no_driver_found", False),
        (5, "cancelled", "rider_cancel", False),
        (6, "cancelled", None, False),
        (7, None, None, False),
    ]
    got = {
        r.trip_id: (r.trip_classification, r.is_completed, r.is_revenue_eligible, r.has_cancellation_fee)
        for r in ride_staging.trips(trips(spark, rows)).collect()
    }
    assert got == {
        1: ("completed", True, True, False),
        2: ("completed_fraud", True, False, False),
        3: (None, True, False, False),
        4: ("cancelled_no_match", False, False, False),
        5: ("cancelled_billed", False, False, True),
        6: ("cancelled_billed", False, False, False),
        7: (None, False, False, False),
    }


def test_bridge_closes_and_equals_the_cash_ledger(spark, data):
    models = ride(spark, data)
    lines = {r.line_item: r.amount_usd for r in ride_finance.closing_bridge(models.int_trips_enriched).collect()}
    assert lines["Unexplained residual"] == 0
    net = lines.pop("Net collected revenue")
    assert sum(lines.values()) == net
    tieout = ride_finance.cash_ledger_tieout(models.stg_trips, models.stg_payments).collect()[0]
    assert tieout.ties_out and tieout.mart_net_revenue_usd == net


def test_repriced_capture_moves_to_its_own_bridge_line(spark, data):
    raw = ride(spark, data).raw
    cheaper = conform(
        raw.payments.selectExpr("* except (amount)", "if(trip_id = 3, amount - 1, amount) as amount"),
        RIDE_SCHEMAS["payments"],
    )
    models = ride(spark, data, payments=cheaper)
    lines = {r.line_item: r.amount_usd for r in ride_finance.closing_bridge(models.int_trips_enriched).collect()}
    assert lines["Unexplained residual"] == 0
    assert lines["Less: captured below the quoted fare"] != 0


def quotes(spark, rows):
    return spark.createDataFrame(rows, "currency string, q string, quote_id long, r double").selectExpr(
        "currency", "cast(q as date) as quoted_on", "quote_id", "cast(r as decimal(10,4)) as usd_rate"
    )


def test_daily_rates_carry_forward_and_fill_back(spark):
    given = [("GBP", "2024-01-03", 1, 1.2), ("GBP", "2024-01-05", 2, 1.3), ("GBP", "2024-01-05", 3, 1.4),
             ("GBP", "2024-02-01", 4, 9.0), ("EUR", "2023-12-01", 5, 1.0), ("EUR", "2023-12-20", 6, 1.1)]
    daily = fx_rates.daily_rates(quotes(spark, given), spark_lit(date(2024, 1, 1)), spark_lit(date(2024, 1, 6)))
    got = {(r.currency, r.rate_date.day): (float(r.usd_rate), r.quoted_on) for r in daily.collect()}
    third, fifth, old = date(2024, 1, 3), date(2024, 1, 5), date(2023, 12, 20)
    assert got == {
        ("GBP", 1): (1.2, third), ("GBP", 2): (1.2, third), ("GBP", 3): (1.2, third), ("GBP", 4): (1.2, third),
        ("GBP", 5): (1.4, fifth), ("GBP", 6): (1.4, fifth),
        **{("EUR", d): (1.1, old) for d in range(1, 7)},
    }


def test_haversine(spark):
    km = spark.sql("select 0.0 as a, 0.0 as b, 0.0 as c, 1.0 as d").select(
        ride_distance.haversine_km(*[spark_col(n) for n in "abcd"]).alias("km")
    )
    assert abs(km.collect()[0].km - 111.1949) < 0.001


def spark_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def contribution_lines(models):
    extra = ride_audits.extra_captures(models.raw.payments)
    rows = ride_finance.contribution_bridge(models.int_trips_enriched, models.stg_payments, models.raw.payments, extra).collect()
    return [r.amount_usd for r in rows]


def test_contribution_bridge_adds_up(spark, data):
    models = ride(spark, data)
    lines = contribution_lines(models)
    assert lines[0] + lines[1] == lines[2]
    assert sum(lines[2:5]) == lines[5]
    assert sum(lines[5:9]) == lines[9]
    assert sum(lines[9:13]) == lines[13] and lines[11:13] == [0, 0]
    cash = models.raw.payments.where("payment_status = 'captured'").selectExpr(
        "sum(amount * if(currency = 'GBP', 1.27, 1.00)) as c"
    )
    assert lines[13] == cash.collect()[0].c


def test_contribution_bridge_states_stray_captures_and_the_residual(spark, data):
    from pyspark.sql import functions as F

    raw = ride(spark, data).raw
    one = raw.payments.where("payment_status = 'captured' and currency = 'USD'").orderBy("payment_id").limit(1)
    changed = {"trip_id": "-77L", "amount": "cast(12.50 as decimal(12,2))"}
    stray = one.withColumns({name: F.expr(value) for name, value in changed.items()})
    both = [stray.withColumn("payment_id", F.lit(k).cast("bigint")) for k in (-5, -4)]
    lines = contribution_lines(ride(spark, data, payments=raw.payments.union(both[0]).union(both[1])))
    # Two captures of a trip that nobody knows: one is a duplicate, one is stray.
    assert (lines[11], lines[12]) == (Decimal("12.5"), 0)
    assert sum(lines[9:13]) == lines[13]
    # A capture in another currency than its trip's cannot be explained by trip.
    switched = raw.payments.withColumn("currency", F.expr("if(currency = 'GBP', 'USD', currency)"))
    assert contribution_lines(ride(spark, data, payments=switched))[12] != 0


def test_trips_without_a_quoted_rate_are_flagged(spark):
    trips = spark.sql(
        """select * from values ('USD', 10.00, timestamp_ntz'2031-05-01 10:00:00'),
           ('GBP', 20.00, timestamp_ntz'2031-05-02 10:00:00'), ('EUR', 5.00, timestamp_ntz'2031-05-02 10:00:00')
           as t(currency, gross_fare, requested_at)"""
    )
    daily = fx_rates.daily_rates(quotes(spark, [("GBP", "2030-01-01", 1, 1.5)]), *fx_rates.calendar_of(trips))
    got = {r.currency: (r.gross_usd_as_of, r.trips_without_rate) for r in fx_rates.convert_as_of(trips, daily).collect()}
    assert got == {"USD": (10, 0), "GBP": (30, 0), "EUR": (None, 1)}


def test_every_onboarding_left_out_is_listed(spark):
    drivers = spark.sql(
        """select * from values (1, timestamp_ntz'2024-01-01 00:00:00'), (1, timestamp_ntz'2024-01-01 00:00:00'),
           (1, null), (2, null), (2, null), (3, timestamp_ntz'2024-01-01 00:00:00') as t(driver_id, onboarded_at)"""
    )
    listed = ride_audits._superseded_onboardings(drivers).collect()
    assert sorted((r.entity_id, r.recorded_at is None) for r in listed) == [(1, False), (1, True), (2, True)]


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_rider_windows_include_their_first_day(spark, data):
    raw = ride(spark, data).raw
    latest = raw.trips.selectExpr("max(requested_at)").collect()[0][0]
    edge = datetime(latest.year, latest.month, latest.day)
    moved = conform(
        raw.trips.where("rider_id <> 0").unionByName(
            raw.trips.where("trip_id = 1").selectExpr(
                "* except (trip_id, rider_id, is_fraud_flagged, requested_at)",
                "900001L as trip_id",
                "0L as rider_id",
                "false as is_fraud_flagged",
                f"timestamp_ntz'{edge}' - interval 30 days as requested_at",
            )
        ),
        RIDE_SCHEMAS["trips"],
    )
    rider = ride(spark, data, trips=moved).mart_riders.where("rider_id = 0").collect()[0]
    assert rider.is_active_30d and rider.lifecycle_stage == "active"


def test_campaign_sets_add_up_to_the_multi_campaign_report(spark, data):
    models = ride(spark, data)
    sets = ride_campaigns.campaign_overlap(models.raw.driver_incentives, models.stg_trips)
    report = ride_finance.multi_campaign_share(models.int_trips_enriched)
    got = sets.selectExpr("sum(trips_exactly)", "sum(trips_with_several_lines)", "sum(spend_usd)").first()
    want = report.selectExpr("sum(incentivized_trips)", "sum(multi_campaign_trips)", "sum(incentive_spend_usd)").first()
    assert tuple(got) == tuple(want)


def test_campaign_sets(spark):
    lines = spark.sql(
        """select * from values (1, 'a', 5.00), (1, 'b', 2.00), (1, 'c', 1.00), (2, 'a', 1.00), (2, 'a', 3.00), (3, 'b', 4.00),
           (3, 'c', 4.00), (4, null, 9.00), (9, 'a', 7.00), (null, 'a', 7.00) as t(trip_id, campaign, bonus_amount)"""
    ).selectExpr("*", "'USD' as currency")
    rows = ride_campaigns.campaign_overlap(lines, spark.range(1, 6).withColumnRenamed("id", "trip_id")).collect()
    got = {r.campaigns: (r.n_campaigns, r.trips_at_least, r.trips_exactly, r.lines, r.spend_usd, r.excess_usd) for r in rows}
    assert got == {
        "a": (1, 2, 1, 2, 4, 1), "b": (1, 2, 0, 0, 0, 0), "c": (1, 2, 0, 0, 0, 0), "a+b": (2, 1, 0, 0, 0, 0),
        "a+c": (2, 1, 0, 0, 0, 0), "b+c": (2, 2, 1, 2, 8, 4), "a+b+c": (3, 1, 1, 3, 8, 3),
    }
    assert ride_campaigns.campaign_overlap(lines.limit(0), spark.range(0).withColumnRenamed("id", "trip_id")).count() == 0
