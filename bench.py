"""Time the headline queries and print one line of JSON.

    BENCH_SF_DIR   data folder  (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores  (default 8)

Feeds and stores are built once, and timed as entries of their own (``load_*``), since every other
query starts from tables that exist. Each query is run in full to a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from twinledger.plans.catalog import query_catalog  # noqa: E402
from twinledger.session import scratch_dir  # noqa: E402
from twinledger.sources import samples  # noqa: E402

HEADLINE = [
    "cleanse_trades",
    "cleanse_to_csv",
    "cleanse_metrics",
    "eod_report",
    "validate_trades",
    "json_payload_ingest",
    "idempotent_append",
    "store_totals",
    "parity_audit",
    "parity_by_batch_totals",
    "missing_ids",
    "reconcile_from_backlog",
    "shadow_outcomes",
    "shadow_outcomes_by_control",
    "running_parity",
    "control_state",
    "failback_proof",
    "recent_trades",
    "throughput_trailing",
    "transaction_report",
    "order_audit_trail",
    "cutover_gate",
    "dual_ingest_drill",
    "stream_redelivery",
    "stream_quarantine",
    "telemetry_snapshot",
]


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def split_input(spark: SparkSession, sf_dir: str, splits: int) -> str:
    """A copy of the given tables in which ``lineitem`` is ``splits`` files, not timed. The given file is one row group,
    which one task alone would read and, up to the first shuffle, work on. The others stay whole: streams take
    a batch per file."""
    path = scratch_dir(spark, "bench_input")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(
            splits if name == "lineitem" else 1
        ).write.parquet(f"{path}/{name}.parquet")
    return path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("twinledger-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    given, sf_dir = sf_dir, split_input(spark, sf_dir, int(cpus))
    timed("load_raw_feed", lambda: samples.raw_trades(spark, sf_dir))
    timed("load_stores", lambda: samples.store_paths(spark, sf_dir))
    timed("load_delivery_feed", lambda: samples.delivery_feed(spark, sf_dir))
    catalog = query_catalog()
    for name in HEADLINE:
        timed(
            name,
            lambda: catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save(),
        )
    rows = samples.event_trades(spark, sf_dir).count()
    scale = re.search(r"sf([0-9.]+)$", given)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else given,
                "input_splits": int(cpus),
                # Two deliveries of every event trade, loaded into one store.
                "stream_load_rows_per_sec": round(2 * rows / times["stream_redelivery"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
