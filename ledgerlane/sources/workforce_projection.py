"""Workforce raw tables as deterministic projections of customer."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerlane.sources.star import StarTables
from ledgerlane.sources.tables import WORKFORCE_SCHEMAS, conform

# Department codes, names and divisions.
DEPARTMENTS = [
    ("ENG", "Engineering", "Product & Technology"),
    ("PRD", "Product", "Product & Technology"),
    ("DES", "Design", "Product & Technology"),
    ("SAL", "Sales", "Go-To-Market"),
    ("MKT", "Marketing", "Go-To-Market"),
    ("CSM", "Customer Success", "Go-To-Market"),
    ("FIN", "Finance", "Operations"),
    ("HRM", "People & HR", "Operations"),
    ("OPS", "Operations", "Operations"),
    ("LEG", "Legal", "Operations"),
]
_LAST_DAY = "date'2025-12-31'"
#: Customers that one task turns into employees. Each has about sixty pay runs, so a small file of customers is dealt out.
CUSTOMERS_A_TASK = 10_000


def _departments(customer: DataFrame) -> DataFrame:
    """The departments that people are first hired into."""
    details = ", ".join(
        f"struct('{code}' as department_code, '{name}' as department_name, '{division}' as division)"
        for code, name, division in DEPARTMENTS
    )
    return (
        customer.selectExpr("cast(c_custkey % 10 as int) as slot")
        .distinct()
        .selectExpr("slot", f"element_at(array({details}), slot + 1) as detail")
        .selectExpr("10 + slot as department_id", "detail.*", "concat('CC-', 1000 + 10 * slot) as cost_center")
    )


def _before_last_day(day: str) -> str:
    return f"if(({day}) < {_LAST_DAY}, ({day}), null)"


def _employees(customer: DataFrame) -> DataFrame:
    first_end = _before_last_day(
        """case when kind between 12 and 15 then date_add(hire_1, cast(180 + person_id * 13 % 900 as int))
                when kind >= 16 then date_add(hire_1, cast(120 + person_id * 11 % 900 as int)) end"""
    )
    second_end = _before_last_day(
        """case kind when 15 then date_add(end_1, cast(200 + person_id * 7 % 300 as int))
                     when 14 then date_add(end_1, cast(150 + person_id * 7 % 300 as int)) end"""
    )
    rehire_end = _before_last_day("if(person_id % 40 = 19, date_add(hire_4, 200), null)")
    people = (
        customer.selectExpr(
            "c_custkey as person_id",
            "c_custkey % 20 as kind",
            "date_add(date'2016-01-01', cast(c_custkey * 367 % 3500 as int)) as hire_1",
        )
        .selectExpr("*", f"{first_end} as end_1")
        .selectExpr(
            "*", f"{second_end} as end_2", "date_add(end_1, cast(45 + person_id % 5 * 90 as int)) as hire_4"
        )
        .selectExpr("*", f"{rehire_end} as end_4")
    )
    # Each person yields their original record, up to two transfers, a rehire and a duplicate.
    record = """named_struct('employee_id', {id}, 'department_id', 10 + (person_id + {shift}) % 10,
        'hire_date', {hire}, 'termination_date', {end}, 'employment_status', {status},
        'prior_employee_id', {prior})"""
    first_status = """case when end_1 is null then if(person_id % 113 = 7, 'terminated', 'active')
        when kind < 16 then 'transferred' else 'terminated' end"""
    second_status = """case when end_2 is null then 'active' when kind = 15 then 'transferred'
        else 'terminated' end"""
    no_prior = "cast(null as bigint)"
    first = dict(shift=0, hire="hire_1", end="end_1", status=first_status, prior=no_prior)
    moved = "kind between 12 and 15 and end_1 is not null and person_id % 240 <> 12"
    variants = [
        ("true", dict(first, id="person_id * 10 + 1")),
        (
            moved,
            dict(
                id="person_id * 10 + 2",
                shift=3,
                hire="end_1",
                end="end_2",
                status=second_status,
                prior="person_id * 10 + 1",
            ),
        ),
        (
            f"{moved} and kind = 15 and end_2 is not null",
            dict(
                id="person_id * 10 + 3",
                shift=6,
                hire="end_2",
                end="cast(null as date)",
                status="'active'",
                prior="person_id * 10 + 2",
            ),
        ),
        (
            f"kind >= 18 and end_1 is not null and hire_4 < {_LAST_DAY}",
            dict(
                id="person_id * 10 + 4",
                shift=1,
                hire="hire_4",
                end="end_4",
                status="if(end_4 is null, 'active', 'terminated')",
                prior="person_id * 10 + 1",
            ),
        ),
        ("person_id % 97 = 5", dict(first, id="person_id * 10 + 9")),
    ]
    records = ", ".join(
        f"if({condition}, {record.format(**fields)}, null)" for condition, fields in variants
    )
    # Levels, employment types and locations.
    return people.selectExpr(
        "person_id", f"inline(filter(array({records}), r -> r is not null))"
    ).selectExpr(
        "*",
        "concat('Employee ', person_id) as full_name",
        """element_at(array('IC1', 'IC2', 'IC3', 'IC4', 'M1', 'M2', 'M3'), cast(person_id % 7 + 1 as int))
           as job_level""",
        "case person_id % 6 when 4 then 'part_time' when 5 then 'contractor' else 'full_time' end as employment_type",
        """element_at(array('New York', 'London', 'Berlin', 'Singapore', 'Remote-US', 'Remote-EU'),
             cast(person_id % 6 + 1 as int)) as location""",
    )


def _performance_reviews(employees: DataFrame) -> DataFrame:
    return (
        employees.selectExpr(
            "employee_id",
            "person_id",
            "cast(hire_date as date) as hired",
            f"least(5, datediff(coalesce(termination_date, {_LAST_DAY}), hire_date) div 365) as cycles",
        )
        .where("cycles >= 1")
        .selectExpr("*", "explode(sequence(1, cast(cycles as int))) as n")
        .selectExpr(
            "*",
            "date_add(hired, 365 * n) as reviewed",
            "explode(if((employee_id + n) % 50 = 7, array(0, 1), array(0))) as copy",
        )
        .selectExpr(
            "(employee_id * 10 + n) * 10 + copy as review_id",
            "employee_id",
            "person_id",
            "year(reviewed) as review_period",
            # Ratings.
            """element_at(array('outstanding', 'exceeds', 'meets', 'below'),
                 cast((employee_id + n) % 4 + 1 as int)) as rating""",
            "(100 + (employee_id * 7 + n * 13) % 401) * 0.01 as review_score",
            "200000 + employee_id % 60000 as reviewer_id",
            "if((employee_id + n) % 14 = 0, null, reviewed) as review_date",
        )
    )


def _payroll(employees: DataFrame) -> DataFrame:
    return (
        employees.selectExpr(
            "employee_id",
            "person_id",
            "trunc(hire_date, 'MM') as first_month",
            f"trunc(coalesce(termination_date, {_LAST_DAY}), 'MM') as last_month",
        )
        .selectExpr("*", "explode(sequence(first_month, last_month, interval 1 month)) as period")
        .selectExpr("*", "year(period) * 12 + month(period) as month_key")
        .selectExpr(
            "*",
            "period in (first_month, last_month) as is_partial_period",
            "explode(if((employee_id + month_key) % 100 = 7, array(0, 1), array(0))) as copy",
        )
        .selectExpr(
            "(employee_id * 100000 + month_key) * 10 + copy as payroll_id",
            "employee_id",
            "person_id",
            "period as pay_period",
            "(4000 + employee_id * 17 % 14000) * if(is_partial_period, 0.5, 1.0) as gross_pay",
            "case person_id % 6 when 3 then 'GBP' when 4 then 'EUR' when 5 then 'SGD' else 'USD' end as currency",
            "is_partial_period",
            """cast(period as timestamp_ntz)
                 + make_dt_interval(cast(25 + (employee_id + month_key) % 6 as int)) as paid_at""",
        )
    )


def _dealt_out(customer: DataFrame) -> DataFrame:
    """The customers over as many tasks as their number asks for, whatever the files they lie in."""
    tasks = -(-customer.count() // CUSTOMERS_A_TASK)  # the files' footers know the number
    return customer.repartition(tasks) if tasks > 1 else customer


class ProjectedWorkforceTables:
    """The four tables, each projected when first asked for."""

    def __init__(self, spark: SparkSession, star_dir: str):
        self._star = StarTables(spark, star_dir)

    @cached_property
    def departments(self) -> DataFrame:
        return conform(_departments(self._star.customer), WORKFORCE_SCHEMAS["departments"])

    @cached_property
    def employees(self) -> DataFrame:
        return conform(_employees(_dealt_out(self._star.customer)), WORKFORCE_SCHEMAS["employees"])

    @cached_property
    def performance_reviews(self) -> DataFrame:
        return conform(_performance_reviews(self.employees), WORKFORCE_SCHEMAS["performance_reviews"])

    @cached_property
    def payroll(self) -> DataFrame:
        return conform(_payroll(self.employees), WORKFORCE_SCHEMAS["payroll"])
