"""Time the headline queries: prints one JSON line.

Every query starts cold: stage tables of earlier queries are dropped first, so
its time covers reading the source tables, gap filling and roll-up. Results go
to the noop sink. Before the timed runs every query runs once on the smallest
tables (BENCH_WARMUP_DIR, empty for none), so that classes are generated and the
JVM is warm, as in a long-lived session; no data is shared with the timed runs.
BENCH_QUERIES (comma separated) restricts the list.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import tables  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from meterweave.session import session  # noqa: E402

HEADLINE = (
    "validate_readings", "dedupe_readings", "detect_resolution", "fill_gaps", "quality_summary", "asof_temperature",
    "entity_load", "daily_features", "segment_features", "cp_select", "class_percentile", "class_rank", "ramps",
    "peak_events", "day_shape_primary", "recurring_peak_timing", "outlier_days", "interval_coincidence",
    "diversity_factor", "cluster_auto_k",
)


def run(spark, key: str, sf_dir: str) -> float:
    tables.release()
    start = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    only = os.environ.get("BENCH_QUERIES")
    spark = session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # start the JVM's readers
    times = {}
    keys = only.split(",") if only else HEADLINE
    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if warmup_dir and os.path.isdir(warmup_dir):
        for key in keys:
            run(spark, key, warmup_dir)
    for key in keys:
        times[key] = run(spark, key, sf_dir)
        print(f"{key} {times[key]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time, warm JVM, cold stages",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
