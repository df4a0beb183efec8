"""Wall seconds of the headline queries, one JSON line on standard output.

BENCH_SF_DIR: folder of the Parquet tables (default /root/testdata/sf0.1).
BENCH_CPUS: local cores (default 8). BENCH_RUNS: timed runs per query after a warm-up run (default 3); the
median counts. A query whose warm-up took over BENCH_LONG seconds (default 6) is timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from catalogue import QUERIES

HEADLINE = (
    "contract_cast", "contract_cast_report", "json_glob_scan", "pii_hash_text", "pii_roundtrip",
    "lake_append", "lake_overwrite", "bronze_full_latest", "latest_by_key", "bronze_full_keys",
    "bronze_full_distinct", "bronze_delta_late", "bronze_delta_nokey", "layer_reconcile",
    "silver_mapper", "silver_full_then_left", "silver_self_join", "silver_day_gap", "model_state_day_gap",
    "silver_merge_key", "silver_merge_composite", "silver_insert_overwrite", "silver_overwrite_append",
    "quality_report", "gold_replace", "gold_date_replace", "gold_date_replace_partition",
    "chain_silver_gold", "adhoc_topk", "run_attempts", "payload_flatten", "live_packets",
    "json_stable", "event_json", "instrument_lookup", "stream_replay_dedup", "stream_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    long = float(os.environ.get("BENCH_LONG", "6"))
    warehouse = os.environ.get("BENCH_WAREHOUSE", "/tmp/bench-warehouse")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.checkpoint.dir", os.environ.get("BENCH_WORK", f"{warehouse}-work"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        warm = once(name)
        timed = [once(name) for _ in range(1 if warm > long else runs)]
        seconds[name] = round(statistics.median(timed), 3)
        print(f"{name}: warm-up {warm:.2f}, median {seconds[name]:.2f}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_wall_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
    }))


if __name__ == "__main__":
    main()
