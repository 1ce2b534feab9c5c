"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per
query (the median is reported).  Results are forced with a ``noop`` write.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from farelens.registry import REGISTRY  # noqa: E402
from farelens.registry import base  # noqa: E402
from farelens.session import build_session  # noqa: E402

QUERIES = [
    "q01_sales_extract", "q06_daily_occupancy_income", "q11_accounting_channels",
    "a01_trip_collapse", "j01_sales_with_trips", "j02_with_loyalty", "p19_known_mail",
    "e01_route_day_elasticity", "e02_forward_calendar", "a05_advance_curve", "a06_seat_demand",
    "a09_fare_bands", "j04_attach_all_classes", "w07_log_smoother", "w08_decay_segments",
    "a22_daily_base", "e05_price_elasticity", "m25_customer_train_set", "m16_customer_features",
    "a17_customer_route_income", "j11_unknown_customers", "m01_fare_features", "m04_z_score",
    "m23_demand_response",
]


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(f"local[{cpus}]", int(cpus), "farelens-bench", "16g")
    found: dict[str, float] = {}
    # The shared ticket table is built once and timed on its own.
    found["tickets_table"] = timed(base.tickets, spark, sf_dir)
    for name in QUERIES:
        query = REGISTRY[name].query
        timed(query, spark, sf_dir)
        found[name] = statistics.median(timed(query, spark, sf_dir) for _ in range(runs))
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(found.values()), 3),
        "unit": "sec", "queries": {k: round(v, 3) for k, v in found.items()},
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
