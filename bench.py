"""Seconds per headline query; prints one JSON line.

Reads `$BENCH_SF_DIR` (default sf0.1) and runs on `local[$BENCH_CPUS]`. Each
query is timed to full materialisation; `tables` is the one-time derivation of
the six procure-to-pay tables, `features`, `scored` and so on are the shared
stages when first computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tallymark.plans.pipeline import audit  # noqa: E402
from tallymark.plans.registry import ALL, present  # noqa: E402

STAGES = ("near", "report", "features", "zscore_risk", "scaled", "forest", "autoencoder", "scored", "risk",
          "explained_cases")
HEADLINE = (
    "q1_po_deviation", "q2_same_amount_month", "q3_split_orders_by_month", "q7_early_first_use",
    "r1_exact_duplicates", "r2_near_duplicates", "r14_rule_counts", "m4_permutation_importance", "r3_split_orders",
    "r4_match_failures", "r6_after_hours", "r9_new_vendors", "r10_exceptions_report",
    "r13_evaluation", "f0_assembly", "f12_scaler", "m2_anomaly_score", "m8_roc_auc",
    "m14_model_comparison", "k8_tier_distribution", "k12_case_queue", "k14_vendor_risk",
    "e6_log_amount_boxes", "e8_benford", "e14_vendor_stats", "e19_match_rate",
    "v1_shape_and_nulls", "v3_orphans", "x5_sentences", "p1_kpi_row",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallymark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, work):
        start = time.perf_counter()
        out = work()
        seconds[name] = round(time.perf_counter() - start, 3)
        return out

    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # session warm-up, not timed
    a = timed("tables", lambda: audit(spark, sf_dir))
    for stage in STAGES:
        timed(f"stage_{stage}", lambda: getattr(a, stage))
    for name in HEADLINE:
        timed(name, lambda: present(ALL[name](a)).write.format("noop").mode("overwrite").save())
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
