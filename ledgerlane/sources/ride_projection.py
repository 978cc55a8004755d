"""Ride-hailing raw tables as deterministic projections of customer, supplier and orders.

Fixed values throughout: names of cities, products, statuses, reasons, campaigns and payment methods, and the
numbers that deal them over the keys.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.sources.star import StarTables
from ledgerlane.sources.tables import RIDE_SCHEMAS, conform


def _city(nation_key: str) -> str:
    return f"element_at(array('metro_north', 'bayview', 'rivermouth', 'sunbelt'), {nation_key} % 4 + 1)"


def _later(moment: str, seconds: str) -> str:
    return f"{moment} + make_dt_interval(0, 0, 0, {seconds})"


def _riders(customer: DataFrame) -> DataFrame:
    signup = _later("timestamp_ntz'2022-07-10 00:00:00'", "(c_custkey * 37 % 905) * 86400")
    return customer.selectExpr(
        "c_custkey as rider_id",
        f"{_city('c_nationkey')} as home_city",
        """case when c_custkey % 10 <= 6 then 'active' when c_custkey % 10 = 7 then 'dormant'
                when c_custkey % 10 = 8 then 'suspended' else 'guest' end as account_status""",
        f"{signup} as signup_at",
        "if(c_custkey % 4 = 0 and c_custkey > 0, c_custkey - 1, null) as referred_by",
    )


def _drivers(supplier: DataFrame) -> DataFrame:
    # One output row per onboarding: a tenth of the drivers come back once.
    onboarded = _later(
        "timestamp_ntz'2022-01-11 00:00:00'", "(s_suppkey * 53 % 1000 + days_later) * 86400"
    )
    return supplier.selectExpr(
        "*", "explode(if(s_suppkey % 10 = 3, array(0, 120 + s_suppkey % 380), array(0))) as days_later"
    ).selectExpr(
        "s_suppkey as driver_id",
        f"{_city('s_nationkey')} as home_city",
        """case when days_later > 0 or s_suppkey % 10 <= 7 then 'active'
                when s_suppkey % 10 = 8 then 'inactive' else 'deactivated' end as driver_status""",
        "(300 + s_suppkey * 37 % 201) * 0.01 as rating",
        f"{onboarded} as onboarded_at",
        "case s_suppkey % 4 when 0 then 'premium' when 1 then 'xl' else 'standard' end as vehicle_class",
    )


def _trips(orders: DataFrame, customer: DataFrame, supplier: DataFrame) -> DataFrame:
    booked = orders.selectExpr(
        "o_orderkey as trip_id",
        "if(o_custkey % 50 = 49, o_custkey - 1, o_custkey) as rider_id",
        "cast(floor(o_totalprice / 100) as decimal(10,0)) as cents",
    )
    home = customer.selectExpr("c_custkey as rider_id", "c_nationkey")
    requested = _later("timestamp_ntz'2024-01-01 00:00:00'", "trip_id * 104729 % 31536000")
    return (
        booked.join(home, "rider_id")
        .withColumn("drivers", supplier.agg(F.count("*")).scalar())
        .selectExpr(
            "*",
            "trip_id * 31 % drivers as slot",
            "trip_id % 6 <> 0 as done",
            """if(trip_id % 6 = 0, element_at(
                 array('rider_cancel', 'driver_cancel', 'no_driver_found', 'rider_no_show'),
                 cast((trip_id div 6) % 4 + 1 as int)), null) as cancel_reason""",
            f"{requested} as requested_at",
        )
        .selectExpr(
            "trip_id",
            "rider_id",
            """case when cancel_reason = 'no_driver_found' then null when slot % 10 = 9 then slot - 1
                    else slot end as driver_id""",
            f"{_city('c_nationkey')} as city",
            "element_at(array('pool', 'premium', 'xl', 'standard'), cast(trip_id % 4 + 1 as int)) as product",
            "if(done, 'completed', 'cancelled') as trip_status",
            "cancel_reason",
            """case when done then cents * 0.01
                    when cancel_reason = 'no_driver_found' or (trip_id div 24) % 2 = 0 then 0
                    else floor(cents * 0.4) * 0.01 end as gross_fare""",
            "case trip_id % 10 when 8 then 1.5 when 9 then 2.0 else 1.0 end as surge_multiplier",
            "if(c_nationkey % 4 = 2, 'GBP', 'USD') as currency",
            "done and trip_id % 31 = 1 as is_fraud_flagged",
            "40 + (trip_id * 7919 % 100000) * 0.000001 as pickup_lat",
            "-73 - (trip_id * 6131 % 100000) * 0.000001 as pickup_lon",
            "40 + (trip_id * 3571 % 100000) * 0.000001 as dropoff_lat",
            "-73 - (trip_id * 1999 % 100000) * 0.000001 as dropoff_lon",
            "requested_at",
            f"{_later('requested_at', 'if(trip_id % 500 = 7, -600, 5 + trip_id % 85)')} as accepted_at",
            f"if(done, {_later('requested_at', '300 + trip_id % 300')}, null) as started_at",
            f"if(done, {_later('requested_at', '600 + trip_id % 3000')}, null) as ended_at",
        )
    )


def _payments(trips: DataFrame) -> DataFrame:
    return (
        trips.where("gross_fare > 0")
        .selectExpr(
            "trip_id",
            "rider_id",
            "currency",
            "gross_fare as amount",
            f"{_later('coalesce(ended_at, accepted_at)', '60 + trip_id % 3000')} as first_try",
            """explode(filter(array(0, 1, 2), n -> case n
                 when 0 then trip_id % 12 = 1 or trip_id % 33 = 2
                 when 1 then trip_id % 33 <> 2
                 else trip_id % 33 <> 2 and trip_id % 59 = 5 end)) as attempt""",
        )
        .selectExpr(
            "trip_id * 10 + attempt as payment_id",
            "trip_id",
            "rider_id",
            "if(attempt = 0, 'failed', 'captured') as payment_status",
            "amount",
            "currency",
            """case when attempt = 0 then 'card'
                    else element_at(array('wallet', 'card', 'cash'), cast(trip_id % 3 + 1 as int)) end
               as payment_method""",
            "if(attempt = 0, 0, floor(amount * 2.5) * 0.01 + 0.20) as processor_fee",
            f"{_later('first_try', 'if(attempt = 0, 0, 600)')} as attempted_at",
            f"if(attempt > 0, {_later('first_try', 'if(attempt = 1, 660, 665)')}, null) as captured_at",
        )
    )


def _driver_incentives(trips: DataFrame) -> DataFrame:
    return (
        trips.where("trip_status = 'completed'")
        .selectExpr(
            "*", "explode(filter(array(1, 2), n -> if(n = 1, trip_id % 3 = 1, trip_id % 12 = 1))) as line"
        )
        .selectExpr(
            "trip_id * 10 + line as incentive_id",
            "driver_id",
            "trip_id",
            """element_at(array('quest_weekly', 'surge_guarantee', 'referral_bonus', 'consecutive_trips',
                 'peak_hour_boost'), cast((trip_id + line) % 5 + 1 as int)) as campaign""",
            """if(line = 1, floor(gross_fare * 20) * 0.01 + 1.50, floor(gross_fare * 10) * 0.01 + 1.00)
               as bonus_amount""",
            "currency",
            "ended_at as earned_at",
            f"{_later('ended_at', '(3 + trip_id % 31) * 86400')} as paid_at",
        )
    )


class ProjectedRideTables:
    """The five tables, each projected when first asked for."""

    def __init__(self, spark: SparkSession, star_dir: str):
        self._star = StarTables(spark, star_dir)

    @cached_property
    def riders(self) -> DataFrame:
        return conform(_riders(self._star.customer), RIDE_SCHEMAS["riders"])

    @cached_property
    def drivers(self) -> DataFrame:
        return conform(_drivers(self._star.supplier), RIDE_SCHEMAS["drivers"])

    @cached_property
    def trips(self) -> DataFrame:
        trips = _trips(self._star.orders, self._star.customer, self._star.supplier)
        return conform(trips, RIDE_SCHEMAS["trips"])

    @cached_property
    def payments(self) -> DataFrame:
        return conform(_payments(self.trips), RIDE_SCHEMAS["payments"])

    @cached_property
    def driver_incentives(self) -> DataFrame:
        return conform(_driver_incentives(self.trips), RIDE_SCHEMAS["driver_incentives"])
