"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlake.plans.registry import QUERIES  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

HEADLINE = (
    "a10_reconcile", "a11_gold_mart", "a2_silver_metrics", "a8_silver_rollup", "a12_dim_rollups",
    "a14_fanout_inflation", "a16_dirty_profile", "a20_feed_inventory", "a21_device_rings", "a22_mcc_concentration",
    "a23_bug_signatures", "a24_pii_audit", "a25_plan_summary", "a26_deceleration_gate", "a27_qualify",
    "j1_left_preagg", "j4_dimension_join", "j4_dimension_join_salted", "j5_orphan_report", "j6_hash_parity",
    "p8_null_class", "p22_enrich_orders", "s1_scan_feed", "s13_upsert", "u1_parity", "w1_dedup_latest",
    "w2_velocity", "w2_velocity_silver", "q1_dq_scan",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # start the JVM's lazy parts before timing
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
