"""Ride-hailing statements over customer, supplier and orders."""

from __future__ import annotations

# Names of cities, products, statuses, reasons, campaigns and payment methods, and the numbers that
# deal them over the keys.
RAW = """
raw_riders AS (
  SELECT c_custkey AS rider_id,
         ['metro_north', 'bayview', 'rivermouth', 'sunbelt'][c_nationkey % 4 + 1] AS home_city,
         CASE c_custkey % 10 WHEN 7 THEN 'dormant' WHEN 8 THEN 'suspended' WHEN 9 THEN 'guest'
              ELSE 'active' END AS account_status,
         TIMESTAMP '2022-07-10 00:00:00' + to_days(CAST((c_custkey * 37) % 905 AS INT)) AS signup_at,
         CASE WHEN c_custkey > 0 AND c_custkey % 4 = 0 THEN c_custkey - 1 END AS referred_by
  FROM customer),
first_onboarding AS (
  SELECT s_suppkey AS driver_id,
         ['metro_north', 'bayview', 'rivermouth', 'sunbelt'][s_nationkey % 4 + 1] AS home_city,
         CASE s_suppkey % 10 WHEN 8 THEN 'inactive' WHEN 9 THEN 'deactivated' ELSE 'active' END AS driver_status,
         CAST((300 + (s_suppkey * 37) % 201) * 0.01 AS DECIMAL(4,2)) AS rating,
         TIMESTAMP '2022-01-11 00:00:00' + to_days(CAST((s_suppkey * 53) % 1000 AS INT)) AS onboarded_at,
         CASE s_suppkey % 4 WHEN 0 THEN 'premium' WHEN 1 THEN 'xl' ELSE 'standard' END AS vehicle_class
  FROM supplier),
raw_drivers AS (
  SELECT * FROM first_onboarding
  UNION ALL
  SELECT driver_id, home_city, 'active', rating, onboarded_at + to_days(CAST(120 + driver_id % 380 AS INT)),
         vehicle_class
  FROM first_onboarding WHERE driver_id % 10 = 3),
bookings AS (
  SELECT o_orderkey AS k, CASE WHEN o_custkey % 50 = 49 THEN o_custkey - 1 ELSE o_custkey END AS rider_id,
         CAST(floor(o_totalprice / 100) AS DECIMAL(10,0)) AS cents,
         (o_orderkey * 31) % (SELECT count(*) FROM supplier) AS j,
         o_orderkey % 6 = 0 AS off,
         (o_orderkey // 6) % 4 AS why,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds((o_orderkey * 104729) % 31536000) AS requested_at
  FROM orders),
raw_trips AS (
  SELECT k AS trip_id, rider_id,
         CASE WHEN off AND why = 2 THEN NULL WHEN j % 10 = 9 THEN j - 1 ELSE j END AS driver_id,
         ['metro_north', 'bayview', 'rivermouth', 'sunbelt'][c_nationkey % 4 + 1] AS city,
         ['pool', 'premium', 'xl', 'standard'][k % 4 + 1] AS product,
         CASE WHEN off THEN 'cancelled' ELSE 'completed' END AS trip_status,
         CASE WHEN off THEN ['rider_cancel', 'driver_cancel', 'no_driver_found', 'rider_no_show'][why + 1] END
           AS cancel_reason,
         CAST(CASE WHEN NOT off THEN cents * 0.01 WHEN why = 2 OR (k // 24) % 2 = 0 THEN 0
                   ELSE floor(cents * 0.4) * 0.01 END AS DECIMAL(12,2)) AS gross_fare,
         CAST(CASE k % 10 WHEN 8 THEN 1.5 WHEN 9 THEN 2 ELSE 1 END AS DECIMAL(5,2)) AS surge_multiplier,
         CASE WHEN c_nationkey % 4 = 2 THEN 'GBP' ELSE 'USD' END AS currency,
         NOT off AND k % 31 = 1 AS is_fraud_flagged,
         CAST(40 + ((k * 7919) % 100000) * 0.000001 AS DECIMAL(9,6)) AS pickup_lat,
         CAST(-73 - ((k * 6131) % 100000) * 0.000001 AS DECIMAL(9,6)) AS pickup_lon,
         CAST(40 + ((k * 3571) % 100000) * 0.000001 AS DECIMAL(9,6)) AS dropoff_lat,
         CAST(-73 - ((k * 1999) % 100000) * 0.000001 AS DECIMAL(9,6)) AS dropoff_lon,
         requested_at,
         requested_at + to_seconds(CASE WHEN k % 500 = 7 THEN -600 ELSE 5 + k % 85 END) AS accepted_at,
         CASE WHEN NOT off THEN requested_at + to_seconds(300 + k % 300) END AS started_at,
         CASE WHEN NOT off THEN requested_at + to_seconds(600 + k % 3000) END AS ended_at
  FROM bookings JOIN customer ON c_custkey = rider_id),
chargeable AS (
  SELECT trip_id AS t, rider_id, gross_fare, currency,
         coalesce(ended_at, accepted_at) + to_seconds(60 + trip_id % 3000) AS b,
         ['wallet', 'card', 'cash'][trip_id % 3 + 1] AS method,
         CAST(floor(gross_fare * 2.5) * 0.01 + 0.20 AS DECIMAL(12,2)) AS fee
  FROM raw_trips WHERE gross_fare > 0),
raw_payments AS (
  SELECT t * 10 AS payment_id, t AS trip_id, rider_id, 'failed' AS payment_status, gross_fare AS amount, currency,
         'card' AS payment_method, CAST(0 AS DECIMAL(12,2)) AS processor_fee, b AS attempted_at,
         CAST(NULL AS TIMESTAMP) AS captured_at
  FROM chargeable WHERE t % 12 = 1 OR t % 33 = 2
  UNION ALL
  SELECT t * 10 + 1, t, rider_id, 'captured', gross_fare, currency, method, fee, b + to_seconds(600),
         b + to_seconds(660)
  FROM chargeable WHERE t % 33 <> 2
  UNION ALL
  SELECT t * 10 + 2, t, rider_id, 'captured', gross_fare, currency, method, fee, b + to_seconds(600),
         b + to_seconds(665)
  FROM chargeable WHERE t % 33 <> 2 AND t % 59 = 5),
bonus AS (
  SELECT trip_id, driver_id, currency, ended_at, 1 AS line,
         CAST(floor(gross_fare * 20) * 0.01 + 1.50 AS DECIMAL(12,2)) AS amount
  FROM raw_trips WHERE trip_status = 'completed' AND trip_id % 3 = 1
  UNION ALL
  SELECT trip_id, driver_id, currency, ended_at, 2,
         CAST(floor(gross_fare * 10) * 0.01 + 1.00 AS DECIMAL(12,2))
  FROM raw_trips WHERE trip_status = 'completed' AND trip_id % 12 = 1),
raw_driver_incentives AS (
  SELECT trip_id * 10 + line AS incentive_id, driver_id, trip_id,
         ['quest_weekly', 'surge_guarantee', 'referral_bonus', 'consecutive_trips', 'peak_hour_boost']
           [(trip_id + line) % 5 + 1] AS campaign,
         amount AS bonus_amount, currency, ended_at AS earned_at,
         ended_at + to_days(CAST(3 + trip_id % 31 AS INT)) AS paid_at
  FROM bonus)
"""

MODELS = """
v_riders AS (SELECT *, referred_by IS NOT NULL AS is_referred FROM raw_riders),
v_drivers AS (
  SELECT driver_id, arg_max(home_city, onboarded_at) AS home_city,
         arg_max(driver_status, onboarded_at) AS driver_status,
         arg_max(vehicle_class, onboarded_at) AS vehicle_class, arg_max(rating, onboarded_at) AS rating,
         min(onboarded_at) AS first_onboarded_at, max(onboarded_at) AS last_onboarded_at,
         count(*) > 1 AS is_reonboarded
  FROM raw_drivers GROUP BY driver_id),
v_trips AS (
  SELECT *,
         CASE trip_status
           WHEN 'completed' THEN CASE is_fraud_flagged WHEN true THEN 'completed_fraud' WHEN false THEN 'completed' END
           WHEN 'cancelled' THEN CASE WHEN cancel_reason = 'no_driver_found' THEN 'cancelled_no_match'
                                      ELSE 'cancelled_billed' END END AS trip_classification,
         trip_status = 'completed' AS is_completed,
         coalesce(trip_status = 'completed' AND NOT is_fraud_flagged, false) AS is_revenue_eligible,
         coalesce(trip_status = 'cancelled' AND cancel_reason <> 'no_driver_found', false) AS has_cancellation_fee
  FROM raw_trips),
v_payments AS (
  SELECT trip_id, min(payment_id) AS first_id, count(*) > 1 AS has_duplicate_captures,
         arg_min(payment_id, (captured_at, payment_id)) AS payment_id
  FROM raw_payments WHERE payment_status = 'captured' GROUP BY trip_id),
settled AS (
  SELECT p.*, v.has_duplicate_captures FROM v_payments v JOIN raw_payments p USING (payment_id)),
per_trip AS (
  SELECT trip_id, sum(bonus_amount) AS spend, count(*) AS line_count
  FROM raw_driver_incentives GROUP BY trip_id),
joined AS (
  SELECT t.*, coalesce(s.amount, 0) AS captured_amount, coalesce(s.processor_fee, 0) AS processor_fee,
         coalesce(i.spend, 0) AS incentive_amount,
         CASE WHEN t.currency = 'GBP' THEN 1.27 ELSE 1.00 END AS fx,
         s.payment_id IS NOT NULL AS paid, coalesce(s.has_duplicate_captures, false) AS has_duplicate_captures,
         coalesce(i.line_count > 1, false) AS is_multi_campaign_trip, coalesce(i.line_count, 0) AS lines,
         s.payment_method, s.captured_at
  FROM v_trips t LEFT JOIN settled s ON s.trip_id = t.trip_id LEFT JOIN per_trip i ON i.trip_id = t.trip_id),
fact AS (
  SELECT *, gross_fare * fx AS gross, captured_amount * fx AS cap, processor_fee * fx AS fee,
         incentive_amount * fx AS inc FROM joined),
driver_trips AS (
  SELECT driver_id, count(*) AS assigned, count(*) FILTER (is_completed) AS done,
         count(*) FILTER (trip_status = 'cancelled') AS off, count(*) FILTER (is_fraud_flagged) AS fraud,
         count(*) FILTER (is_revenue_eligible) AS eligible,
         sum(gross) FILTER (is_completed) AS earned, sum(cap) FILTER (is_revenue_eligible) AS collected,
         min(requested_at) AS first_trip_at, max(requested_at) AS last_trip_at,
         count(DISTINCT city) AS cities_operated, count(DISTINCT product) AS products_served
  FROM fact WHERE driver_id IS NOT NULL GROUP BY driver_id),
ledger AS (
  SELECT driver_id, sum(bonus_amount) AS total,
         sum(bonus_amount * CASE WHEN currency = 'GBP' THEN 1.27 ELSE 1.00 END) AS total_usd,
         count(*) AS line_count, count(DISTINCT trip_id) AS trips, count(DISTINCT campaign) AS campaigns
  FROM raw_driver_incentives GROUP BY driver_id),
metrics AS (
  SELECT d.*, coalesce(assigned, 0) AS total_trips_assigned, coalesce(done, 0) AS completed_trips,
         coalesce(off, 0) AS cancelled_trips, coalesce(fraud, 0) AS fraud_flagged_trips,
         coalesce(eligible, 0) AS revenue_eligible_trips,
         coalesce(round(CAST(done AS DOUBLE) / nullif(assigned, 0), 4), 0) AS completion_rate,
         coalesce(round(CAST(fraud AS DOUBLE) / nullif(done, 0), 4), 0) AS fraud_rate,
         CAST(coalesce(earned, 0) AS DOUBLE) AS gross_earnings_usd,
         CAST(coalesce(collected, 0) AS DOUBLE) AS net_captured_usd,
         CAST(coalesce(total, 0) AS DOUBLE) AS total_incentive_paid,
         CAST(coalesce(total_usd, 0) AS DOUBLE) AS total_incentive_paid_usd,
         coalesce(line_count, 0) AS total_incentive_lines, coalesce(trips, 0) AS incentivized_trips,
         coalesce(campaigns, 0) AS campaigns_participated,
         first_trip_at, last_trip_at, cities_operated, products_served
  FROM (SELECT * REPLACE (CAST(rating AS DOUBLE) AS rating) FROM v_drivers) d
  LEFT JOIN driver_trips USING (driver_id) LEFT JOIN ledger USING (driver_id)),
driver_mart AS (
  SELECT m.*, CAST(coalesce(x.leak, 0) AS DOUBLE) AS incentive_on_fraud_trips,
         CASE WHEN completed_trips > 0 THEN CAST((2 * CAST(round(gross_earnings_usd * 10000) AS HUGEINT)
           + 100 * completed_trips) // (200 * completed_trips) AS DOUBLE) / 100 ELSE 0 END AS avg_fare_per_trip_usd,
         CASE WHEN completed_trips > 0 THEN CAST((2 * CAST(round(total_incentive_paid * 10000) AS HUGEINT)
           + 100 * completed_trips) // (200 * completed_trips) AS DOUBLE) / 100 ELSE 0 END AS avg_incentive_per_trip
  FROM metrics m LEFT JOIN (
    SELECT i.driver_id, sum(bonus_amount) AS leak FROM raw_driver_incentives i
    WHERE trip_id IN (SELECT trip_id FROM v_trips WHERE is_fraud_flagged) GROUP BY i.driver_id) x
  USING (driver_id)),
cutoff AS (SELECT CAST(max(requested_at) AS DATE) AS day FROM v_trips),
rider_trips AS (
  SELECT rider_id, count(*) AS asked, count(*) FILTER (is_completed) AS done,
         count(*) FILTER (is_revenue_eligible) AS good, count(*) FILTER (trip_status = 'cancelled') AS off,
         count(*) FILTER (is_fraud_flagged) AS fraud, sum(gross) AS spent,
         sum(cap) FILTER (is_revenue_eligible) AS collected,
         min(requested_at) AS first_trip_at, max(requested_at) AS last_trip_at,
         max(requested_at) FILTER (is_revenue_eligible) AS last_good
  FROM fact GROUP BY rider_id),
activity AS (
  SELECT rider_id, home_city, account_status, signup_at, is_referred,
         coalesce(asked, 0) AS total_trips_requested, coalesce(done, 0) AS completed_trips,
         coalesce(good, 0) AS completed_nonfraud_trips, coalesce(off, 0) AS cancelled_trips,
         coalesce(fraud, 0) AS fraud_trips, CAST(coalesce(spent, 0) AS DOUBLE) AS total_gross_fare_usd,
         CAST(coalesce(collected, 0) AS DOUBLE) AS total_captured_usd, first_trip_at, last_trip_at,
         account_status = 'active' AS is_active_account,
         coalesce(last_good >= day - INTERVAL 30 DAY, false) AS is_active_30d,
         coalesce(last_good >= day - INTERVAL 90 DAY, false) AS is_active_90d,
         coalesce(last_trip_at >= day - INTERVAL 30 DAY, false) AS is_active_any_trip_30d
  FROM v_riders LEFT JOIN rider_trips USING (rider_id), cutoff),
rider_mart AS (
  SELECT *, CASE WHEN total_trips_requested > 0
                 THEN round(CAST(completed_nonfraud_trips AS DOUBLE) / total_trips_requested, 4) ELSE 0 END
              AS completion_rate,
         CASE WHEN completed_trips > 0 THEN CAST((2 * CAST(round(total_gross_fare_usd * 10000) AS HUGEINT)
           + 100 * completed_trips) // (200 * completed_trips) AS DOUBLE) / 100 ELSE 0 END AS avg_fare_per_trip_usd,
         CASE WHEN total_trips_requested = 0 THEN 'never_rode' WHEN is_active_30d THEN 'active'
              WHEN is_active_90d THEN 'lapsing' ELSE 'churned' END AS lifecycle_stage
  FROM activity),
kpis AS (
  SELECT CAST(date_trunc('month', requested_at) AS DATE) AS report_month,
         CAST(sum(gross) FILTER (is_completed) AS DOUBLE) AS gmv_usd,
         CAST(coalesce(sum(cap) FILTER (has_cancellation_fee), 0) AS DOUBLE) AS cancellation_fee_revenue_usd,
         CAST(sum(CASE WHEN is_completed THEN gross WHEN has_cancellation_fee THEN cap ELSE 0 END) AS DOUBLE)
           AS gross_revenue_usd,
         CAST(coalesce(sum(cap - fee) FILTER (is_revenue_eligible), 0) AS DOUBLE) AS net_revenue_usd,
         CAST(coalesce(sum(cap) FILTER (is_fraud_flagged), 0) AS DOUBLE) AS fraud_revenue_usd,
         CAST(coalesce(sum(gross) FILTER (is_revenue_eligible AND NOT paid), 0) AS DOUBLE) AS uncollected_fare_usd,
         CAST(coalesce(sum(fee) FILTER (is_revenue_eligible), 0) AS DOUBLE) AS processor_fees_usd,
         CAST(sum(inc) AS DOUBLE) AS incentive_spend_usd, count(*) AS total_trip_requests,
         count(*) FILTER (is_completed) AS completed_trips,
         count(*) FILTER (trip_status = 'cancelled') AS cancelled_trips,
         count(*) FILTER (is_fraud_flagged) AS fraud_trips,
         count(*) FILTER (is_revenue_eligible) AS revenue_eligible_trips,
         round(CAST(cancelled_trips AS DOUBLE) / total_trip_requests, 4) AS cancellation_rate,
         round(CAST(fraud_trips AS DOUBLE) / nullif(completed_trips, 0), 4) AS fraud_rate,
         CASE WHEN gmv_usd > 0 THEN round(net_revenue_usd / gmv_usd, 4) ELSE 0 END AS take_rate,
         count(DISTINCT rider_id) AS active_riders,
         count(DISTINCT driver_id) FILTER (is_completed) AS active_drivers
  FROM fact GROUP BY report_month),
bridge AS (
  SELECT CAST(sum(gross) FILTER (is_completed) AS DOUBLE) AS gmv_usd,
         CAST(coalesce(sum(cap) FILTER (has_cancellation_fee), 0) AS DOUBLE) AS cancellation_fee_revenue_usd,
         CAST(sum(CASE WHEN is_completed THEN gross WHEN has_cancellation_fee THEN cap ELSE 0 END) AS DOUBLE)
           AS gross_revenue_usd,
         CAST(coalesce(sum(cap) FILTER (is_fraud_flagged AND paid), 0) AS DOUBLE) AS fraud_reversals_usd,
         CAST(coalesce(sum(gross) FILTER (is_revenue_eligible AND NOT paid), 0) AS DOUBLE) AS uncollected_fares_usd,
         CAST(coalesce(sum(fee) FILTER (is_revenue_eligible AND paid), 0) AS DOUBLE) AS processor_fees_usd,
         CAST(coalesce(sum(cap - fee) FILTER (is_revenue_eligible AND paid), 0) AS DOUBLE) AS net_revenue_usd,
         CAST(sum(CASE WHEN is_completed THEN gross ELSE 0 END)
              - sum(CASE WHEN is_revenue_eligible AND paid THEN cap - fee ELSE 0 END) AS DOUBLE) AS total_gap_usd,
         round(fraud_reversals_usd / nullif(total_gap_usd, 0), 4) AS fraud_pct_of_gap,
         round(uncollected_fares_usd / nullif(total_gap_usd, 0), 4) AS uncollected_pct_of_gap,
         round(processor_fees_usd / nullif(total_gap_usd, 0), 4) AS fees_pct_of_gap,
         round(total_gap_usd / nullif(gmv_usd, 0), 4) AS gap_rate,
         CAST(sum(inc) AS DOUBLE) AS total_incentive_spend_usd,
         CAST(coalesce(sum(inc) FILTER (is_fraud_flagged), 0) AS DOUBLE) AS incentive_on_fraud_usd
  FROM fact)
"""

_TRIP_DAYS = "SELECT min(CAST(requested_at AS DATE)) AS a, max(CAST(requested_at AS DATE)) AS b FROM raw_trips"


def quotes(days: str = _TRIP_DAYS) -> str:
    """Daily rates for the calendar from day a to day b of a one-row relation."""
    return f"""
quotes AS (
  SELECT 'GBP' AS currency, DATE '2024-01-04' + CAST((s_suppkey * 53) % 360 AS INT) AS quoted_on,
         arg_max(CAST((12000 + (s_suppkey * 37) % 1500) * 0.0001 AS DECIMAL(10,4)), s_suppkey) AS rate
  FROM supplier GROUP BY quoted_on),
shown AS (SELECT * FROM quotes WHERE quoted_on <= (SELECT b FROM ({days}))),
calendar AS (
  SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS rate_date FROM ({days})),
daily AS (
  SELECT 'GBP' AS currency, c.rate_date, coalesce(q.rate, (SELECT arg_min(rate, quoted_on) FROM shown)) AS rate,
         coalesce(q.quoted_on, (SELECT min(quoted_on) FROM shown)) AS quoted_on
  FROM calendar c ASOF LEFT JOIN shown q ON c.rate_date >= q.quoted_on)
"""


def _over(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n" + body.strip()


def _models(body: str) -> str:
    return _over(RAW, MODELS, body=body)


def _rule(name: str, severity: str, failures: str) -> str:
    return _models(
        f"""SELECT '{name}' AS test, '{severity}' AS severity, n AS failures,
                   CASE WHEN n = 0 THEN 'pass' ELSE '{severity}' END AS status
            FROM (SELECT CAST(({failures}) AS BIGINT) AS n)"""
    )


# Schema tests: kind, model as users name it, relation here, column, extra.
_TESTS = [
    *[(kind, f"raw_{m}", f"raw_{m}", c) for m, c in (
        ("riders", "rider_id"), ("trips", "trip_id"), ("payments", "payment_id"),
        ("driver_incentives", "incentive_id")) for kind in ("not_null", "unique")],
    ("not_null", "raw_drivers", "raw_drivers", "driver_id"),
    *[(kind, m, r, c) for m, r, c in (
        ("stg_riders", "v_riders", "rider_id"), ("stg_drivers", "v_drivers", "driver_id"),
        ("stg_trips", "v_trips", "trip_id"), ("stg_payments", "settled", "trip_id"),
        ("stg_payments", "settled", "payment_id"),
        ("stg_driver_incentives", "raw_driver_incentives", "incentive_id"),
        ("int_trips_enriched", "fact", "trip_id"), ("int_driver_metrics", "metrics", "driver_id"),
        ("int_rider_activity", "activity", "rider_id"), ("mart_drivers", "driver_mart", "driver_id"),
        ("mart_riders", "rider_mart", "rider_id"), ("mart_marketplace_kpis", "kpis", "report_month"),
    ) for kind in ("not_null", "unique")],
]
_VIOLATIONS = {
    "not_null": "SELECT count(*) FROM {r} WHERE {c} IS NULL",
    "unique": "SELECT count({c}) - count(DISTINCT {c}) FROM {r}",
}


def _schema_tests() -> str:
    tests = [(f"{k}:{m}.{c}", _VIOLATIONS[k].format(r=r, c=c)) for k, m, r, c in _TESTS]
    tests += [
        ("not_null:int_trips_enriched.trip_classification",
         "SELECT count(*) FROM fact WHERE trip_classification IS NULL"),
        ("not_null:int_trips_enriched.gross_fare_usd", "SELECT count(*) FROM fact WHERE gross IS NULL"),
        ("accepted_values:stg_trips.trip_classification",
         "SELECT count(*) FROM v_trips WHERE trip_classification NOT IN "
         "('completed', 'completed_fraud', 'cancelled_no_match', 'cancelled_billed')"),
        ("accepted_values:mart_riders.lifecycle_stage",
         "SELECT count(*) FROM rider_mart WHERE lifecycle_stage NOT IN ('active', 'lapsing', 'churned', 'never_rode')"),
        ("accepted_range:int_driver_metrics.completion_rate",
         "SELECT count(*) FROM metrics WHERE completion_rate < 0 OR completion_rate > 1"),
    ]
    rows = " UNION ALL ".join(f"SELECT '{name}' AS test, ({sql}) AS n" for name, sql in tests)
    return _models(
        f"""SELECT test, 'error' AS severity, CAST(n AS BIGINT) AS failures,
                   CASE WHEN n = 0 THEN 'pass' ELSE 'error' END AS status FROM ({rows})"""
    )


_DISTANCE = """
measured AS (
  SELECT f.trip_id, f.city, f.product, CAST(f.surge_multiplier AS DOUBLE) AS surge_multiplier,
         CAST(round(6371 * 2 * asin(sqrt(
           pow(sin((radians(CAST(f.dropoff_lat AS DOUBLE)) - radians(CAST(f.pickup_lat AS DOUBLE))) / 2), 2)
           + cos(radians(CAST(f.pickup_lat AS DOUBLE))) * cos(radians(CAST(f.dropoff_lat AS DOUBLE)))
             * pow(sin((radians(CAST(f.dropoff_lon AS DOUBLE)) - radians(CAST(f.pickup_lon AS DOUBLE))) / 2), 2))),
           6) AS DECIMAL(18,6)) AS km,
         CASE WHEN is_revenue_eligible THEN cap - fee ELSE 0 END AS net
  FROM fact f WHERE is_completed)
"""

RIDE: dict[str, str] = {
    "rh_stg_riders": _over(RAW, MODELS, body="SELECT * FROM v_riders"),
    "rh_stg_drivers": _models("SELECT * REPLACE (CAST(rating AS DOUBLE) AS rating) FROM v_drivers"),
    "rh_stg_trips": _models(
        """SELECT * REPLACE (CAST(gross_fare AS DOUBLE) AS gross_fare,
             CAST(surge_multiplier AS DOUBLE) AS surge_multiplier, CAST(pickup_lat AS DOUBLE) AS pickup_lat,
             CAST(pickup_lon AS DOUBLE) AS pickup_lon, CAST(dropoff_lat AS DOUBLE) AS dropoff_lat,
             CAST(dropoff_lon AS DOUBLE) AS dropoff_lon) FROM v_trips"""
    ),
    "rh_stg_payments": _models(
        """SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(processor_fee AS DOUBLE) AS processor_fee),
                  1 AS capture_rank FROM settled"""
    ),
    "rh_stg_driver_incentives": _models(
        """SELECT i.* REPLACE (CAST(bonus_amount AS DOUBLE) AS bonus_amount), p.line_count AS incentives_per_trip,
                  p.line_count > 1 AS is_multi_campaign_trip
           FROM raw_driver_incentives i JOIN per_trip p USING (trip_id)"""
    ),
    "rh_int_trips_enriched": _models(
        """SELECT trip_id, rider_id, driver_id, city, product, trip_status, cancel_reason, trip_classification,
                  is_completed, is_revenue_eligible, has_cancellation_fee, is_fraud_flagged,
                  CAST(surge_multiplier AS DOUBLE) AS surge_multiplier, currency,
                  CAST(gross_fare AS DOUBLE) AS gross_fare, CAST(captured_amount AS DOUBLE) AS captured_amount,
                  CAST(processor_fee AS DOUBLE) AS processor_fee, CAST(incentive_amount AS DOUBLE) AS incentive_amount,
                  CAST(CASE WHEN is_revenue_eligible OR has_cancellation_fee THEN captured_amount - processor_fee
                            ELSE 0 END AS DOUBLE) AS net_revenue_local,
                  CAST(fx AS DOUBLE) AS exchange_rate, CAST(gross AS DOUBLE) AS gross_fare_usd,
                  CAST(cap AS DOUBLE) AS captured_amount_usd, CAST(fee AS DOUBLE) AS processor_fee_usd,
                  CAST(inc AS DOUBLE) AS incentive_amount_usd, paid AS has_captured_payment, has_duplicate_captures,
                  is_multi_campaign_trip, lines AS incentive_line_count, payment_method,
                  requested_at, accepted_at, started_at, ended_at, captured_at
           FROM fact"""
    ),
    "rh_int_driver_metrics": _models("SELECT * FROM metrics"),
    "rh_int_rider_activity": _models("SELECT * FROM activity"),
    "rh_mart_drivers": _models("SELECT * FROM driver_mart"),
    "rh_mart_riders": _models("SELECT * FROM rider_mart"),
    "rh_mart_marketplace_kpis": _models("SELECT * FROM kpis ORDER BY report_month"),
    "rh_mart_reconciliation": _models("SELECT * FROM bridge"),
    "dq_rh_orphan_trips": _rule(
        "orphan_trips", "error",
        "SELECT count(*) FROM v_trips t WHERE rider_id IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM v_riders r WHERE r.rider_id = t.rider_id)"),
    "dq_rh_orphan_payments": _rule(
        "orphan_payments", "error",
        "SELECT count(*) FROM settled s WHERE trip_id IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM v_trips t WHERE t.trip_id = s.trip_id)"),
    "dq_rh_negative_fares": _rule("negative_fares", "error", "SELECT count(*) FROM v_trips WHERE gross_fare < 0"),
    "dq_rh_future_trips": _rule(
        "future_trips", "warn", "SELECT count(*) FROM v_trips WHERE requested_at > TIMESTAMP '2026-01-01 00:00:00'"),
    "dq_rh_captured_lte_fare": _rule(
        "captured_lte_fare", "warn",
        "SELECT count(*) FROM fact WHERE is_completed AND captured_amount > gross_fare * 1.1"),
    "dq_rh_incentive_recon": _rule(
        "incentive_recon", "error",
        "SELECT count(*) FROM metrics m JOIN ledger l USING (driver_id) "
        "WHERE abs(m.total_incentive_paid - l.total) > 0.01"),
    "dq_rh_no_fraud_revenue": _rule(
        "no_fraud_revenue", "error",
        "SELECT count(*) FROM fact WHERE is_fraud_flagged AND (is_revenue_eligible OR has_cancellation_fee) "
        "AND captured_amount > processor_fee"),
    "dq_rh_gap_bounds": _rule(
        "gap_bounds", "warn", "SELECT count(*) FROM bridge WHERE gap_rate < 0.05 OR gap_rate > 0.20"),
    "dq_rh_kpi_months": _rule("kpi_months", "warn", "SELECT CASE WHEN count(*) < 12 THEN 1 ELSE 0 END FROM kpis"),
    "dq_rh_rider_monotonic": _rule(
        "rider_monotonic", "error",
        "SELECT CASE WHEN count(*) FILTER (is_active_30d) > count(*) FILTER (is_active_90d) THEN 1 ELSE 0 END "
        "FROM rider_mart"),
    "dq_rh_schema_tests": _schema_tests(),
    "rh_row_counts": _models(
        """SELECT 'int_trips_enriched' AS model, (SELECT count(*) FROM fact) AS row_count
           UNION ALL SELECT 'int_driver_metrics', (SELECT count(*) FROM metrics)
           UNION ALL SELECT 'int_rider_activity', (SELECT count(*) FROM activity)
           UNION ALL SELECT 'mart_drivers', (SELECT count(*) FROM driver_mart)
           UNION ALL SELECT 'mart_riders', (SELECT count(*) FROM rider_mart)
           UNION ALL SELECT 'mart_marketplace_kpis', (SELECT count(*) FROM kpis)
           UNION ALL SELECT 'mart_reconciliation', (SELECT count(*) FROM bridge)"""
    ),
    "rh_bridge_components": _models(
        """SELECT CAST(sum(gross) FILTER (is_completed) AS DOUBLE) AS gmv_usd,
                  CAST(sum(cap) FILTER (is_revenue_eligible) AS DOUBLE) AS revenue_captured_usd,
                  CAST(sum(fee) FILTER (is_revenue_eligible) AS DOUBLE) AS fees_usd,
                  CAST(sum(cap) FILTER (is_fraud_flagged) AS DOUBLE) AS fraud_captured_usd,
                  CAST(sum(inc) AS DOUBLE) AS total_incentives_usd FROM fact"""
    ),
    "rh_incentive_recon_detail": _models(
        """SELECT driver_id, total_incentive_paid AS mart_total, CAST(total AS DOUBLE) AS raw_total,
                  total_incentive_paid - CAST(total AS DOUBLE) AS diff,
                  abs(total_incentive_paid - total) <= 0.01 AS reconciles
           FROM driver_mart JOIN ledger USING (driver_id)"""
    ),
    "rh_active_rider_counts": _models(
        """SELECT count(*) FILTER (is_active_account) AS active_by_crm,
                  count(*) FILTER (is_active_30d) AS active_30d_completed,
                  count(*) FILTER (is_active_90d) AS active_90d_completed,
                  count(*) FILTER (is_active_any_trip_30d) AS active_30d_any_trip FROM rider_mart"""
    ),
    "rh_failed_attempts": _models(
        """SELECT f.payment_id, f.trip_id, f.payment_method, f.currency, CAST(f.amount AS DOUBLE) AS amount,
                  f.attempted_at, s.captured_at AS recovered_at, s.payment_id IS NOT NULL AS was_recovered
           FROM raw_payments f LEFT JOIN settled s ON s.trip_id = f.trip_id WHERE f.payment_status = 'failed'"""
    ),
    "rh_retry_rates": _models(
        """SELECT attempt_month, count(*) AS trips_attempted, CAST(sum(n) AS BIGINT) AS attempts,
                  CAST(sum(bad) AS BIGINT) AS failed_attempts,
                  count(*) FILTER (bad > 0 AND n > 1) AS trips_retried,
                  count(*) FILTER (bad > 0 AND bad < n) AS trips_recovered,
                  round(sum(bad) / sum(n), 4) AS failure_rate,
                  round(count(*) FILTER (bad > 0 AND n > 1) / count(*), 4) AS retry_rate
           FROM (SELECT trip_id, CAST(date_trunc('month', min(attempted_at)) AS DATE) AS attempt_month,
                        count(*) AS n, count(*) FILTER (payment_status = 'failed') AS bad
                 FROM raw_payments GROUP BY trip_id) GROUP BY attempt_month"""
    ),
    "rh_multi_campaign_pct": _models(
        """SELECT CAST(date_trunc('month', requested_at) AS DATE) AS report_month, count(*) AS incentivized_trips,
                  count(*) FILTER (lines > 1) AS multi_campaign_trips, CAST(sum(inc) AS DOUBLE) AS incentive_spend_usd,
                  CAST(coalesce(sum(inc) FILTER (lines > 1), 0) AS DOUBLE) AS multi_campaign_spend_usd,
                  round(count(*) FILTER (lines > 1) / count(*), 4) AS pct_trips_multi_campaign
           FROM fact WHERE lines > 0 GROUP BY report_month"""
    ),
    "rh_kpis_by_capture_month": _models(
        """SELECT cash_month, CAST(sum(n) AS BIGINT) AS captures, CAST(sum(cap) AS DOUBLE) AS captured_usd,
                  CAST(sum(net) AS DOUBLE) AS net_revenue_usd,
                  CAST(sum(fees) AS DOUBLE) AS cancellation_fee_revenue_usd,
                  CAST(sum(fraud) AS DOUBLE) AS fraud_captured_usd, CAST(sum(k) AS BIGINT) AS incentive_lines_paid,
                  CAST(sum(bonus) AS DOUBLE) AS incentives_paid_usd
           FROM (SELECT CAST(date_trunc('month', captured_at) AS DATE) AS cash_month, 1 AS n, cap,
                        CASE WHEN is_revenue_eligible THEN cap - fee ELSE 0 END AS net,
                        CASE WHEN has_cancellation_fee THEN cap ELSE 0 END AS fees,
                        CASE WHEN is_fraud_flagged THEN cap ELSE 0 END AS fraud, 0 AS k, 0 AS bonus
                 FROM fact WHERE paid
                 UNION ALL
                 SELECT CAST(date_trunc('month', paid_at) AS DATE), 0, 0, 0, 0, 0, 1,
                        bonus_amount * CASE WHEN currency = 'GBP' THEN 1.27 ELSE 1.00 END
                 FROM raw_driver_incentives)
           GROUP BY cash_month"""
    ),
    "rh_trip_distance": _over(
        RAW, MODELS, _DISTANCE,
        body="""SELECT trip_id, city, product, surge_multiplier, CAST(km AS DOUBLE) AS distance_km,
                       CAST(net AS DOUBLE) AS net_revenue_usd,
                       round(CAST(net AS DOUBLE) / nullif(CAST(km AS DOUBLE), 0), 4) AS revenue_per_km FROM measured""",
    ),
    "rh_surge_by_distance": _over(
        RAW, MODELS, _DISTANCE,
        body="""SELECT city, CAST(floor(km / 2) * 2 AS BIGINT) AS band_from_km, count(*) AS trips,
                       CAST(sum(km) AS DOUBLE) AS total_km, CAST(sum(net) AS DOUBLE) AS net_revenue_usd,
                       round(CAST(sum(net) AS DOUBLE) / nullif(CAST(sum(km) AS DOUBLE), 0), 4) AS revenue_per_km,
                       round(sum(surge_multiplier) / count(*), 4) AS avg_surge
                FROM measured GROUP BY city, band_from_km""",
    ),
    "rh_eta_bands": _over(
        RAW, MODELS, _DISTANCE,
        """timed AS (
             SELECT d.city, CAST(hour(t.requested_at) AS INT) AS h, CAST(floor(km / 2) * 2 AS BIGINT) AS band,
                    CAST(epoch(t.started_at) - epoch(t.requested_at) AS BIGINT) AS waited,
                    CAST(epoch(t.ended_at) - epoch(t.started_at) AS BIGINT) AS rode, CAST(km * 1000000 AS BIGINT) AS mm
             FROM measured d JOIN raw_trips t ON t.trip_id = d.trip_id),
           taken AS (
             SELECT city, h, band, 'pickup_seconds' AS measure, waited AS x FROM timed WHERE waited >= 0
             UNION ALL SELECT city, h, band, 'ride_seconds', rode FROM timed WHERE rode >= 0
             UNION ALL SELECT city, h, band, 'metres_an_hour', mm * 3600 // (rode * 1000) FROM timed WHERE rode > 0),
           spread AS (
             SELECT 'city_hour_band' AS level, city, h, band, measure, x FROM taken
             UNION ALL SELECT 'city_hour', city, h, NULL, measure, x FROM taken
             UNION ALL SELECT 'city', city, NULL, NULL, measure, x FROM taken
             UNION ALL SELECT 'all', NULL, NULL, NULL, measure, x FROM taken),
           placed AS (
             SELECT *, row_number() OVER (PARTITION BY level, city, h, band, measure ORDER BY x) AS place,
                    count(*) OVER (PARTITION BY level, city, h, band, measure) AS n,
                    (1::BIGINT << greatest(length(bin(x)) - 7, 0)) AS w
             FROM spread),
           celled AS (SELECT *, x - x % w + (w - 1) // 2 AS cell FROM placed)""",
        body="""SELECT level, city, h AS request_hour, band AS band_from_km, measure, any_value(n) AS trips,
                       max(cell) FILTER (place = (n * 50 + 99) // 100) AS median, max(cell) FILTER (place = (n * 90 + 99) // 100) AS p90
                FROM celled GROUP BY level, city, h, band, measure""",
    ),
    "rh_clock_skew": _models(
        """SELECT trip_id, city, trip_status, requested_at, accepted_at,
                  date_diff('second', accepted_at, requested_at) AS skew_seconds
           FROM raw_trips WHERE accepted_at < requested_at"""
    ),
    "rh_cash_ledger_tieout": _over(
        RAW, MODELS,
        """cash AS (
             SELECT s.amount * CASE WHEN s.currency = 'GBP' THEN 1.27 ELSE 1.00 END AS got,
                    s.processor_fee * CASE WHEN s.currency = 'GBP' THEN 1.27 ELSE 1.00 END AS kept, t.*
             FROM settled s LEFT JOIN (SELECT trip_id AS t, is_completed, is_fraud_flagged, has_cancellation_fee,
                                              is_revenue_eligible FROM v_trips) t ON t.t = s.trip_id),
           ledger_side AS (
             SELECT sum(got) AS a, sum(got) FILTER (is_completed AND is_fraud_flagged) AS b,
                    sum(got) FILTER (has_cancellation_fee) AS c, sum(kept) FILTER (is_revenue_eligible) AS d FROM cash),
           mart_side AS (SELECT sum(cap - fee) FILTER (is_revenue_eligible) AS m FROM fact)""",
        body="""SELECT CAST(a AS DOUBLE) AS captured_cash_usd, CAST(b AS DOUBLE) AS fraud_cash_usd,
                       CAST(c AS DOUBLE) AS cancellation_fee_cash_usd, CAST(d AS DOUBLE) AS processor_fees_usd,
                       CAST(m AS DOUBLE) AS mart_net_revenue_usd, CAST(a - b - c - d AS DOUBLE) AS ledger_net_revenue_usd,
                       CAST(a - b - c - d - m AS DOUBLE) AS difference_usd, abs(a - b - c - d - m) <= 0.01 AS ties_out
                FROM ledger_side, mart_side""",
    ),
    "rh_period_restatement": _over(
        RAW, MODELS,
        """then_trips AS (
             SELECT * REPLACE (is_fraud_flagged AND requested_at <= TIMESTAMP '2024-06-01' AS is_fraud_flagged)
             FROM raw_trips WHERE requested_at <= TIMESTAMP '2024-07-01'),
           then_pay AS (
             SELECT DISTINCT ON (trip_id) *, count(*) OVER (PARTITION BY trip_id) > 1 AS twice FROM raw_payments
             WHERE payment_status = 'captured' AND attempted_at <= TIMESTAMP '2024-07-01' AND captured_at <= TIMESTAMP '2024-07-01'
             ORDER BY trip_id, captured_at, payment_id),
           then_inc AS (
             SELECT trip_id, sum(bonus_amount) AS spend FROM raw_driver_incentives
             WHERE earned_at <= TIMESTAMP '2024-07-01' GROUP BY trip_id),
           then_fact AS (
             SELECT t.*, CASE WHEN t.currency = 'GBP' THEN 1.27 ELSE 1.00 END AS fx, p.payment_id IS NOT NULL AS paid,
                    coalesce(twice, false) AS twice, coalesce(p.amount, 0) AS got, coalesce(p.processor_fee, 0) AS cost,
                    coalesce(i.spend, 0) AS spend, trip_status = 'completed' AS done,
                    trip_status = 'completed' AND NOT is_fraud_flagged AS good
             FROM then_trips t LEFT JOIN then_pay p ON p.trip_id = t.trip_id LEFT JOIN then_inc i ON i.trip_id = t.trip_id),
           compared AS (
             SELECT f.requested_at,
                    CASE WHEN e.is_fraud_flagged <> f.is_fraud_flagged THEN 'fraud_flag'
                         WHEN NOT e.paid AND f.paid THEN 'late_capture'
                         WHEN NOT e.twice AND f.has_duplicate_captures THEN 'duplicate_capture'
                         WHEN e.spend <> f.incentive_amount THEN 'late_incentive'
                         WHEN e.got <> f.captured_amount OR e.cost <> f.processor_fee OR e.gross_fare <> f.gross_fare THEN 'amended'
                    END AS cause,
                    CASE WHEN f.is_completed THEN gross ELSE 0 END - CASE WHEN e.done THEN e.gross_fare * e.fx ELSE 0 END AS gmv,
                    CASE WHEN f.is_revenue_eligible AND f.paid THEN cap - fee ELSE 0 END
                      - CASE WHEN e.good AND e.paid THEN (e.got - e.cost) * e.fx ELSE 0 END AS net,
                    inc - e.spend * e.fx AS bonus
             FROM fact f JOIN then_fact e ON e.trip_id = f.trip_id)""",
        body="""SELECT CAST(date_trunc('month', requested_at) AS DATE) AS report_month, cause, count(*) AS trips,
                       CAST(sum(gmv) AS DOUBLE) AS gmv_change_usd, CAST(sum(net) AS DOUBLE) AS net_revenue_change_usd,
                       CAST(sum(bonus) AS DOUBLE) AS incentives_change_usd
                FROM compared WHERE cause IS NOT NULL GROUP BY ALL""",
    ),
    "rh_changed_months": _over(
        RAW,
        """then_trips AS (
             SELECT * REPLACE (is_fraud_flagged AND requested_at <= TIMESTAMP '2024-06-01' AS is_fraud_flagged)
             FROM raw_trips WHERE requested_at <= TIMESTAMP '2024-07-01'),
           then_rows AS (
             SELECT 'trips' AS feed, requested_at AS moment, trip_id, CAST(t AS VARCHAR) AS content FROM then_trips t
             UNION ALL
             SELECT 'payments', attempted_at, trip_id, CAST(p AS VARCHAR) FROM raw_payments p
             WHERE attempted_at <= TIMESTAMP '2024-07-01' AND coalesce(captured_at <= TIMESTAMP '2024-07-01', true)
             UNION ALL
             SELECT 'driver_incentives', earned_at, trip_id, CAST(i AS VARCHAR) FROM raw_driver_incentives i
             WHERE earned_at <= TIMESTAMP '2024-07-01'),
           now_rows AS (
             SELECT 'trips' AS feed, requested_at AS moment, trip_id, CAST(t AS VARCHAR) AS content FROM raw_trips t
             UNION ALL SELECT 'payments', attempted_at, trip_id, CAST(p AS VARCHAR) FROM raw_payments p
             UNION ALL SELECT 'driver_incentives', earned_at, trip_id, CAST(i AS VARCHAR) FROM raw_driver_incentives i),
           unequal AS (
             (SELECT * FROM then_rows EXCEPT ALL SELECT * FROM now_rows)
             UNION ALL (SELECT * FROM now_rows EXCEPT ALL SELECT * FROM then_rows)),
           all_rows AS (
             SELECT feed, strftime(r.moment, '%Y-%m') AS month, 1 AS b, 0 AS a, strftime(t.requested_at, '%Y-%m') AS own
             FROM then_rows r LEFT JOIN then_trips t ON t.trip_id = r.trip_id
             UNION ALL
             SELECT feed, strftime(r.moment, '%Y-%m'), 0, 1, strftime(t.requested_at, '%Y-%m')
             FROM now_rows r LEFT JOIN raw_trips t ON t.trip_id = r.trip_id)""",
        body="""SELECT feed, month, CAST(sum(b) AS BIGINT) AS rows_before, CAST(sum(a) AS BIGINT) AS rows_after,
                       array_to_string(list_sort(list_distinct(list(coalesce(own, 'no trip')))), ',') AS reached
                FROM all_rows WHERE (feed, month) IN (SELECT (feed, strftime(moment, '%Y-%m')) FROM unequal)
                GROUP BY feed, month""",
    ),
    "rh_campaign_overlap": _over(
        RAW, MODELS,
        """lines AS (
             SELECT trip_id, campaign, bonus_amount * CASE WHEN currency = 'GBP' THEN 1.27 ELSE 1.00 END AS usd
             FROM raw_driver_incentives WHERE campaign IS NOT NULL AND trip_id IN (SELECT trip_id FROM raw_trips)),
           sets AS (
             SELECT trip_id, list_sort(list_distinct(list(campaign))) AS c, count(*) AS n, sum(usd) AS spend, max(usd) AS best
             FROM lines GROUP BY trip_id),
           names AS (SELECT list_sort(list_distinct(list(campaign))) AS l FROM lines),
           groups AS (
             SELECT list_filter(l, lambda x, i: (k >> (i - 1)) % 2 = 1) AS g
             FROM (SELECT l, unnest(range(1, 1 << len(l))) AS k FROM names))""",
        body="""SELECT array_to_string(g, '+') AS campaigns, CAST(len(g) AS BIGINT) AS n_campaigns, count(*) AS trips_at_least,
                       count(*) FILTER (c = g) AS trips_exactly, CAST(coalesce(sum(n) FILTER (c = g), 0) AS BIGINT) AS lines,
                       count(*) FILTER (c = g AND n > 1) AS trips_with_several_lines,
                       CAST(coalesce(sum(spend) FILTER (c = g), 0) AS DOUBLE) AS spend_usd,
                       CAST(coalesce(sum(spend - best) FILTER (c = g), 0) AS DOUBLE) AS excess_usd
                FROM groups JOIN sets ON list_has_all(c, g) GROUP BY g""",
    ),
    "rh_quarantine": _over(
        RAW, MODELS,
        """broken AS (
             SELECT 'raw_riders' AS model, rider_id AS k, 'not_null:raw_riders.rider_id' AS rule FROM raw_riders WHERE rider_id IS NULL
             UNION ALL SELECT 'stg_trips', trip_id, 'clock_skew' FROM v_trips WHERE accepted_at < requested_at
             UNION ALL SELECT 'stg_trips', trip_id, 'negative_fares' FROM v_trips WHERE gross_fare < 0
             UNION ALL SELECT 'stg_trips', trip_id, 'future_trips' FROM v_trips WHERE requested_at > TIMESTAMP '2026-01-01'
             UNION ALL SELECT 'stg_trips', trip_id, 'orphan_trips' FROM v_trips t ANTI JOIN raw_riders r ON r.rider_id = t.rider_id
                       WHERE t.rider_id IS NOT NULL
             UNION ALL SELECT 'stg_trips', trip_id, 'accepted_values:stg_trips.trip_classification' FROM v_trips WHERE
                       trip_classification NOT IN ('completed', 'completed_fraud', 'cancelled_no_match', 'cancelled_billed')
             UNION ALL SELECT 'stg_payments', trip_id, 'orphan_payments' FROM settled s
                       ANTI JOIN raw_trips t ON t.trip_id = s.trip_id WHERE s.trip_id IS NOT NULL
             UNION ALL SELECT 'int_trips_enriched', trip_id, 'captured_lte_fare' FROM fact
                       WHERE is_completed AND captured_amount > gross_fare * 1.1
             UNION ALL SELECT 'int_trips_enriched', trip_id, 'no_fraud_revenue' FROM fact
                       WHERE is_fraud_flagged AND (is_revenue_eligible OR has_cancellation_fee) AND captured_amount > processor_fee)""",
        body="""SELECT model, CAST(k AS VARCHAR) AS row_key, string_agg(rule, ',' ORDER BY rule) AS rules
                FROM broken GROUP BY model, k""",
    ),
    "rh_contribution_bridge": _over(
        RAW, MODELS,
        """parts AS (
             SELECT sum(gross) FILTER (is_completed) AS gmv, sum(cap - fee) FILTER (is_revenue_eligible AND paid) AS net,
                    sum(inc) AS inc, coalesce(sum(inc) FILTER (is_fraud_flagged), 0) AS bad,
                    sum(fee) FILTER (is_revenue_eligible AND paid) AS fees, sum(cap) AS cash,
                    coalesce((SELECT sum(p.amount * CASE WHEN p.currency = 'GBP' THEN 1.27 ELSE 1.00 END)
                              FROM raw_payments p JOIN settled s ON s.trip_id = p.trip_id
                              WHERE p.payment_status = 'captured' AND p.payment_id <> s.payment_id), 0) AS twice,
                    sum(cap) FILTER (is_revenue_eligible AND paid) AS good,
                    (SELECT sum(amount * CASE WHEN currency = 'GBP' THEN 1.27 ELSE 1.00 END)
                     FROM raw_payments WHERE payment_status = 'captured') AS reported,
                    coalesce((SELECT sum(amount * CASE WHEN currency = 'GBP' THEN 1.27 ELSE 1.00 END)
                              FROM settled WHERE trip_id NOT IN (SELECT trip_id FROM raw_trips)), 0) AS stray
             FROM fact)""",
        body="""SELECT line_no, line_item, CAST(amount AS DOUBLE) AS amount_usd FROM parts,
                LATERAL (VALUES (1, 'Gross merchandise value', gmv),
                  (2, 'Less: gap to net collected revenue', net - gmv),
                  (3, 'Net collected revenue', net),
                  (4, 'Less: incentives on sound trips', bad - inc),
                  (5, 'Less: incentives on fraud trips', -bad),
                  (6, 'Contribution after incentives', net - inc),
                  (7, 'Add back: incentives', inc),
                  (8, 'Add back: processor fees', fees),
                  (9, 'Add: cash that is not revenue (fraud and cancellation fees)', cash - good),
                  (10, 'Captured cash, each trip once', cash),
                  (11, 'Add: duplicate captures', twice),
                  (12, 'Add: captures of unknown trips', stray),
                  (13, 'Unexplained residual', reported - cash - twice - stray),
                  (14, 'Cash as the processor reports it', reported)) AS v(line_no, line_item, amount)""",
    ),
    "rh_kpis_at_monthly_rate": _over(
        RAW, MODELS, quotes(),
        """rates AS (
             SELECT currency, CAST(date_trunc('month', rate_date) AS DATE) AS report_month,
                    round(CAST(sum(rate) AS DOUBLE) / count(*), 6) AS avg_usd_rate FROM daily GROUP BY ALL),
           sums AS (
             SELECT CAST(date_trunc('month', requested_at) AS DATE) AS report_month, currency,
                    count(*) FILTER (is_completed) AS completed_trips,
                    CAST(coalesce(sum(gross_fare) FILTER (is_completed), 0) AS DOUBLE) AS gmv_local,
                    CAST(sum(captured_amount) AS DOUBLE) AS captured_local,
                    CAST(coalesce(sum(processor_fee) FILTER (is_revenue_eligible), 0) AS DOUBLE) AS processor_fees_local,
                    CAST(coalesce(sum(captured_amount - processor_fee) FILTER (is_revenue_eligible), 0) AS DOUBLE)
                      AS net_revenue_local,
                    CAST(sum(incentive_amount) AS DOUBLE) AS incentives_local
             FROM fact GROUP BY ALL),
           priced AS (
             SELECT s.*, CASE WHEN s.currency = 'USD' THEN 1.0::DOUBLE ELSE r.avg_usd_rate END AS avg_usd_rate
             FROM sums s LEFT JOIN rates r USING (report_month, currency))""",
        body="""SELECT *, round(gmv_local * avg_usd_rate, 2) AS gmv_usd, round(captured_local * avg_usd_rate, 2) AS captured_usd,
                       round(processor_fees_local * avg_usd_rate, 2) AS processor_fees_usd,
                       round(net_revenue_local * avg_usd_rate, 2) AS net_revenue_usd,
                       round(incentives_local * avg_usd_rate, 2) AS incentives_usd FROM priced""",
    ),
    "rh_bridge_residual": _over(
        RAW,
        MODELS,
        """parts AS (
             SELECT sum(gross) FILTER (is_completed) AS gmv, sum(cap - fee) FILTER (is_revenue_eligible AND paid) AS net,
                    sum(cap) FILTER (is_fraud_flagged AND is_completed AND paid) AS a,
                    sum(gross) FILTER (is_fraud_flagged AND is_completed AND NOT paid) AS b,
                    sum(gross) FILTER (is_revenue_eligible AND NOT paid) AS c,
                    sum(fee) FILTER (is_revenue_eligible AND paid) AS d,
                    sum(gross - cap) FILTER (is_completed AND paid) AS e
             FROM fact)""",
        body="""SELECT line_no, line_item, CAST(amount AS DOUBLE) AS amount_usd,
                  CASE WHEN line_no BETWEEN 2 AND 7 THEN round(-CAST(amount AS DOUBLE) / CAST(gmv - net AS DOUBLE), 4) END
                    AS pct_of_gap
           FROM (
             SELECT 1 AS line_no, 'Gross merchandise value' AS line_item, gmv AS amount, gmv, net FROM parts
             UNION ALL SELECT 2, 'Less: fraud captured then reversed', -a, gmv, net FROM parts
             UNION ALL SELECT 3, 'Less: fraud fares never captured', -coalesce(b, 0), gmv, net FROM parts
             UNION ALL SELECT 4, 'Less: eligible fares never captured', -c, gmv, net FROM parts
             UNION ALL SELECT 5, 'Less: processor fees', -d, gmv, net FROM parts
             UNION ALL SELECT 6, 'Less: captured below the quoted fare', -e, gmv, net FROM parts
             UNION ALL SELECT 7, 'Unexplained residual', a + coalesce(b, 0) + c + d + e - (gmv - net), gmv, net FROM parts
             UNION ALL SELECT 8, 'Net collected revenue', net, gmv, net FROM parts)"""
    ),
    "rh_dedup_audit": _models(
        """SELECT 'driver_onboarding' AS entity, driver_id AS entity_id, CAST(NULL AS BIGINT) AS discarded_id,
                  CAST(NULL AS BIGINT) AS kept_id, r.onboarded_at AS recorded_at, CAST(0 AS DOUBLE) AS excess_usd
           FROM (SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY onboarded_at DESC NULLS LAST) AS nth
                 FROM raw_drivers) r WHERE nth > 1
           UNION ALL
           SELECT 'duplicate_capture', p.trip_id, p.payment_id, s.payment_id, p.captured_at,
                  CAST(p.amount * CASE WHEN p.currency = 'GBP' THEN 1.27 ELSE 1.00 END AS DOUBLE)
           FROM raw_payments p JOIN settled s ON s.trip_id = p.trip_id
           WHERE p.payment_status = 'captured' AND p.payment_id <> s.payment_id"""
    ),
    "fx_daily_rates": _over(
        RAW, quotes(), body="SELECT currency, rate_date, CAST(rate AS DOUBLE) AS usd_rate, quoted_on FROM daily"),
    "fx_monthly_rates": _over(
        RAW, quotes(),
        body="""SELECT currency, CAST(date_trunc('month', rate_date) AS DATE) AS rate_month,
                       round(CAST(sum(rate) AS DOUBLE) / count(*), 6) AS avg_usd_rate,
                       CAST(arg_max(rate, rate_date) AS DOUBLE) AS month_end_usd_rate, count(*) AS days,
                       count(*) FILTER (rate_date = quoted_on) AS quoted_days
                FROM daily GROUP BY currency, rate_month""",
    ),
    "fx_asof_moment": _over(
        RAW, MODELS, quotes(),
        """ticks AS (
             SELECT 'GBP' AS currency, arg_max(CAST((12000 + (s_suppkey * 37) % 1500) * 0.0001 AS DECIMAL(10,4)), s_suppkey) AS tick,
                    TIMESTAMP '2024-01-04' + to_days(CAST((s_suppkey * 53) % 360 AS INT)) + to_seconds((s_suppkey * 7919) % 86400)
                      AS ticked_at
             FROM supplier GROUP BY ticked_at
             HAVING CAST(ticked_at AS DATE) <= (SELECT max(CAST(requested_at AS DATE)) FROM v_trips)),
           met AS (
             SELECT t.currency, t.gross_fare, t.requested_at, k.tick, k.ticked_at
             FROM v_trips t ASOF LEFT JOIN ticks k ON k.currency = t.currency AND t.requested_at >= k.ticked_at),
           priced AS (
             SELECT m.*, CAST(requested_at AS DATE) AS d, m.currency = 'GBP' AND tick IS NULL AS back,
                    CASE m.currency WHEN 'USD' THEN 1.0000
                         WHEN 'GBP' THEN coalesce(tick, (SELECT arg_min(tick, ticked_at) FROM ticks)) END AS x,
                    CASE m.currency WHEN 'USD' THEN 1.0000 ELSE y.rate END AS y
             FROM met m LEFT JOIN daily y ON y.currency = m.currency AND y.rate_date = CAST(requested_at AS DATE))""",
        body="""SELECT CAST(date_trunc('month', d) AS DATE) AS report_month, currency, count(*) AS trips,
                       CAST(sum(gross_fare) AS DOUBLE) AS gross_local, CAST(sum(gross_fare * x) AS DOUBLE) AS gross_usd_at_moment,
                       CAST(sum(gross_fare * y) AS DOUBLE) AS gross_usd_on_day, CAST(sum(gross_fare * (x - y)) AS DOUBLE) AS difference_usd,
                       count(*) FILTER (x <> y) AS trips_at_another_rate,
                       count(*) FILTER (CAST(ticked_at AS DATE) < d) AS trips_on_carried_rate,
                       count(*) FILTER (back) AS trips_before_first_quote, count(*) FILTER (x IS NULL) AS trips_without_rate
                FROM priced GROUP BY report_month, currency""",
    ),
    "fx_asof_rates": _over(
        RAW, MODELS, quotes(),
        body="""SELECT CAST(date_trunc('month', requested_at) AS DATE) AS report_month, t.currency, count(*) AS trips,
                       CAST(sum(gross_fare) AS DOUBLE) AS gross_local,
                       CAST(sum(gross_fare * CASE WHEN t.currency = 'GBP' THEN 1.27 ELSE 1.00 END) AS DOUBLE)
                         AS gross_usd_fixed,
                       CAST(sum(gross_fare * CASE WHEN t.currency = 'USD' THEN 1.0000 ELSE rate END) AS DOUBLE)
                         AS gross_usd_as_of,
                       count(*) FILTER (t.currency <> 'USD' AND rate IS NULL) AS trips_without_rate,
                       count(*) FILTER (quoted_on <> rate_date) AS trips_on_carried_rate,
                       CAST(coalesce(max(abs(date_diff('day', quoted_on, rate_date))), 0) AS BIGINT)
                         AS max_quote_distance_days
                FROM v_trips t LEFT JOIN daily d
                  ON d.currency = t.currency AND d.rate_date = CAST(t.requested_at AS DATE)
                GROUP BY report_month, t.currency""",
    ),
}

# However they are brought up to date, fact and rates are the same.
RIDE["rh_trips_by_month"] = RIDE["rh_int_trips_enriched"]
RIDE["fx_daily_rates_merged"] = RIDE["fx_daily_rates"]
