"""Time headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores; BENCH_QUERIES
(comma-separated, or ALL) chooses other queries. Every query runs once unmeasured, then BENCH_RUNS times
(default 1); the best time counts. Results go to Spark's noop sink, so all rows are computed and none collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lake_queries import QUERIES
from telemetry_lake import build_session

HEADLINE = (
    "vehicle_stat_table",
    "stat_engineStates",
    "engine_immobilizer",
    "fault_codes",
    "fault_codes_obdii",
    "fault_codes_j1939",
    "reefer_engine_hours",
    "reefer_temperature",
    "reefer_alarms",
    "safety_events",
    "vehicle_idling",
    "fuel_energy",
    "tags_children_vehicles",
    "devices",
    "device_health_reasons",
    "envelope_unwrap",
    "flatten_struct",
    "normalize_list",
    "canonical_json",
    "distinct_rows",
    "distinct_on_key",
    "distinct_nested",
    "file_manifest",
    "gap_detection",
    "incremental_transform",
    "plan_requests",
    "fanout_keys",
    "fanout_chunks",
    "parse_params",
    "interval_slices",
    "conditional_update",
    "write_partitioned",
    "warehouse_load",
    "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "ALL" else chosen.split(",") if chosen else list(HEADLINE)
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for attempt in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - started
            if attempt:
                best = taken if best is None else min(best, taken)
        times[name] = round(best, 3)
        print(f"{name} {best:.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
