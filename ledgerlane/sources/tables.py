"""The nine raw tables, with explicit schemas, read from and written to Parquet."""

from __future__ import annotations

from types import SimpleNamespace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names and types of the raw feeds.
RIDE_SCHEMAS = {
    "riders": """rider_id BIGINT, home_city STRING, account_status STRING, signup_at TIMESTAMP_NTZ,
        referred_by BIGINT""",
    "drivers": """driver_id BIGINT, home_city STRING, driver_status STRING, rating DECIMAL(4,2),
        onboarded_at TIMESTAMP_NTZ, vehicle_class STRING""",
    "trips": """trip_id BIGINT, rider_id BIGINT, driver_id BIGINT, city STRING, product STRING,
        trip_status STRING, cancel_reason STRING, gross_fare DECIMAL(12,2), surge_multiplier DECIMAL(5,2),
        currency STRING, is_fraud_flagged BOOLEAN, pickup_lat DECIMAL(9,6), pickup_lon DECIMAL(9,6),
        dropoff_lat DECIMAL(9,6), dropoff_lon DECIMAL(9,6), requested_at TIMESTAMP_NTZ,
        accepted_at TIMESTAMP_NTZ, started_at TIMESTAMP_NTZ, ended_at TIMESTAMP_NTZ""",
    "payments": """payment_id BIGINT, trip_id BIGINT, rider_id BIGINT, payment_status STRING,
        amount DECIMAL(12,2), currency STRING, payment_method STRING, processor_fee DECIMAL(12,2),
        attempted_at TIMESTAMP_NTZ, captured_at TIMESTAMP_NTZ""",
    "driver_incentives": """incentive_id BIGINT, driver_id BIGINT, trip_id BIGINT, campaign STRING,
        bonus_amount DECIMAL(12,2), currency STRING, earned_at TIMESTAMP_NTZ, paid_at TIMESTAMP_NTZ""",
}
WORKFORCE_SCHEMAS = {
    "departments": """department_id BIGINT, department_code STRING, department_name STRING,
        division STRING, cost_center STRING""",
    "employees": """employee_id BIGINT, person_id BIGINT, full_name STRING, department_id BIGINT,
        job_level STRING, employment_type STRING, location STRING, hire_date TIMESTAMP_NTZ,
        termination_date TIMESTAMP_NTZ, employment_status STRING, prior_employee_id BIGINT""",
    "performance_reviews": """review_id BIGINT, employee_id BIGINT, person_id BIGINT, review_period INT,
        rating STRING, review_score DECIMAL(5,2), reviewer_id BIGINT, review_date TIMESTAMP_NTZ""",
    "payroll": """payroll_id BIGINT, employee_id BIGINT, person_id BIGINT, pay_period TIMESTAMP_NTZ,
        gross_pay DECIMAL(12,2), currency STRING, is_partial_period BOOLEAN, paid_at TIMESTAMP_NTZ""",
}


class RideTables(Protocol):
    """Anything that holds the five ride-hailing tables."""

    riders: DataFrame
    drivers: DataFrame
    trips: DataFrame
    payments: DataFrame
    driver_incentives: DataFrame


class WorkforceTables(Protocol):
    """Anything that holds the four workforce tables."""

    departments: DataFrame
    employees: DataFrame
    performance_reviews: DataFrame
    payroll: DataFrame


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select and cast to a declared schema; a missing column is an error."""
    columns = T.StructType.fromDDL(ddl).fields
    return df.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in columns])


def _read(spark: SparkSession, path: str, schemas: dict[str, str]) -> SimpleNamespace:
    return SimpleNamespace(
        **{name: spark.read.schema(ddl).parquet(f"{path}/raw_{name}") for name, ddl in schemas.items()}
    )


def read_ride_tables(spark: SparkSession, path: str) -> RideTables:
    return _read(spark, path, RIDE_SCHEMAS)


def read_workforce_tables(spark: SparkSession, path: str) -> WorkforceTables:
    return _read(spark, path, WORKFORCE_SCHEMAS)


def write_raw_tables(tables: RideTables | WorkforceTables, schemas: dict[str, str], path: str) -> None:
    """Full-replace load: running it again leaves the same tables."""
    for name, ddl in schemas.items():
        conform(getattr(tables, name), ddl).write.mode("overwrite").parquet(f"{path}/raw_{name}")


# Keys the large tables are joined and deduplicated on.
RIDE_KEYS = {"trips": "trip_id", "payments": "trip_id", "driver_incentives": "trip_id"}
WORKFORCE_KEYS = {"employees": "employee_id", "payroll": "employee_id"}


def save_bucketed_tables(
    tables: RideTables | WorkforceTables,
    schemas: dict[str, str],
    keys: dict[str, str],
    database: str,
    buckets: int,
) -> None:
    """Store the tables in the catalog, the keyed ones bucketed and sorted on their key.

    Deduplication and joins on the key then read matching buckets together and need no shuffle.
    """
    for name, ddl in schemas.items():
        df, key = conform(getattr(tables, name), ddl), keys.get(name)
        if key is None:
            writer = df.write
        else:
            # Same hash as the buckets, so every bucket is one file.
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        writer.mode("overwrite").format("parquet").saveAsTable(f"{database}.raw_{name}")


def load_tables(spark: SparkSession, schemas: dict[str, str], database: str) -> SimpleNamespace:
    """Tables stored by ``save_bucketed_tables``, or any catalog tables with these names."""
    return SimpleNamespace(**{name: spark.table(f"{database}.raw_{name}") for name in schemas})
