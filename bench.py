"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per query
(the median counts) and BENCH_ONLY an optional comma-separated list of query names.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from ledgerlane.plans.registry import QUERIES, RIDE_MODELS, WORKFORCE_MODELS
from ledgerlane.session import build_session

HEADLINES = [
    *RIDE_MODELS,
    *WORKFORCE_MODELS,
    "dq_rh_schema_tests",
    "dq_hr_schema_tests",
    "rh_cash_ledger_tieout",
    "rh_bridge_residual",
    "rh_kpis_by_capture_month",
    "rh_surge_by_distance",
    "rh_dedup_audit",
    "hr_department_movements",
    "hr_attrition_standard",
    "hr_payroll_cost_tieout",
    "hr_payroll_reassigned",
    "hr_payroll_cancelled",
    "fx_asof_rates",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINES
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("rh_mart_reconciliation", "hr_workforce_kpis"):
        run(name)
    seconds = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
