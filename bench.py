"""Seconds per headline query on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tabwarden import catalog  # noqa: E402
from tabwarden.session import local_session  # noqa: E402

HEADLINE = [
    "drift_report", "drift_against_stored", "psi_by_feature", "mean_shift_by_feature", "baseline_numeric", "baseline_categorical",
    "baseline_report", "column_profile", "value_counts", "dedupe_rows", "dataset_fingerprint", "stratified_split", "stratified_folds",
    "clean_customer_score", "row_violations", "batch_summary", "contract_check", "prediction_log", "class_metrics", "select_candidate",
    "registry_version_artifacts", "trigger_cooldown", "impute_scale", "one_hot_tree", "lineage_ingest", "sliding_window_distribution",
    "window_over_window_drift", "labelled_predictions", "delayed_label_performance", "curated_set", "stream_drift", "train_candidates",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = catalog.queries()
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # the first job of a session starts it up
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()
