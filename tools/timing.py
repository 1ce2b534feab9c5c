"""Time the headline queries on Spark and their SQL on DuckDB; prints a markdown table.

One warm-up, then the median of the timed runs; Spark results are forced with a ``noop``
write, DuckDB results are fetched as Arrow.
"""

from __future__ import annotations

import datetime as dt
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from bench import QUERIES, timed  # noqa: E402
from check import oracle_connection  # noqa: E402
from farelens.registry import REGISTRY, base  # noqa: E402
from farelens.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark, con = build_session("local[8]", 8, "farelens-timing", "16g"), oracle_connection(sf_dir)
    con.execute("SET threads = 8")
    today = dt.date.today()
    built = timed(base.tickets, spark, sf_dir)
    print(f"| tickets_table (built once, cold) | {built:.2f} | - | "
          f"{base.tickets(spark, sf_dir).count()} | 8 | {today} |", flush=True)
    for name in QUERIES:
        entry = REGISTRY[name]
        timed(entry.query, spark, sf_dir)
        ours = statistics.median(timed(entry.query, spark, sf_dir) for _ in range(runs))
        theirs = None
        if entry.sql is not None:
            found = []
            for _ in range(runs):
                start = time.perf_counter()
                con.execute(entry.sql).to_arrow_table()
                found.append(time.perf_counter() - start)
            theirs = statistics.median(found)
        rows = entry.query(spark, sf_dir).count()
        print(f"| {name} | {ours:.2f} | {'-' if theirs is None else f'{theirs:.2f}'} | {rows} | 8 "
              f"| {today} |", flush=True)


if __name__ == "__main__":
    main()
