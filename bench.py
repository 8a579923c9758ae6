"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the list below), BENCH_WARMUP (folder of smaller tables each query is run on
once before it is timed, so that start-up and code generation do not count; default
/root/testdata/sf0.001, empty for none).
"""

from __future__ import annotations

import json
import os
import time

from checks import REGISTRY
from tidemark.session import local_session

HEADLINE = [
    "full_extract", "cdc_ts_window", "cdc_ts_multi_column", "custom_sql_cast_columns", "dedup_by_key",
    "scd0_append", "scd1_upsert", "scd2_apply", "scd2_counts", "scd2_target", "upsert_sliced_target", "filter_reload",
    "full_replace", "typed_load", "stage_round_trip_comma", "stage_quoting", "stage_rejects",
    "replay_backlog_scd1", "replay_backlog_scd2", "job_state_fold", "run_stats_by_table", "daily_volume",
    "discover_keys", "reconcile_counts", "datagen_orders", "multi_table_run",
]


def run(spark, name: str, sf: str) -> None:
    REGISTRY[name][0](spark, sf).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    warm = os.environ.get("BENCH_WARMUP", "/root/testdata/sf0.001")
    times = {}
    for name in wanted:
        if warm and os.path.isdir(warm):
            run(spark, name, warm)
        start = time.time()
        run(spark, name, sf)
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
