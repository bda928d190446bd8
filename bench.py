"""Wall time of the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "d7_macro_auc", "d10_split_scores", "d11_bootstrap_macro", "d12_paired_delta", "d12_paired_delta_poisson", "d14_component_comparison", "d15_group_bootstrap_delta",
    "d15_group_bootstrap_delta_poisson",
    "d18_case_burden", "d20_pairwise_pearson", "d28_available_source_mean", "d34_label_quality", "d35_slot_coverage", "d5_leakage_groups",
    "c2_gold_override", "c5_training_pool", "e1_rank_mean", "e2_normalized_ranks", "e8_slot_selection", "e10_slice_order",
    "e11_through_plane_geometry", "e12_series_qc", "e21_budget_admission", "h2_table_fingerprint", "h9_recover_span", "h10_split_report",
    "k9_manifest_violations", "p3_make_folds", "p12_blend_screen", "p13_final_submission", "p14_extraction_batch", "p17_series_values",
    "i4_window_throughput", "i6_failure_breaker",
)


def main() -> None:
    from pyspark.sql import SparkSession

    import catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load()
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the JVM, not a query
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
