"""Headline timings: prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all headline queries), BENCH_MODELS=0 to skip model fits.
Each query is forced to full evaluation through the no-op sink (every column computed).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from isohyet.session import get_spark  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", max(8, 2 * cpus), app_name="isohyet-bench",
                      extra={"spark.driver.memory": "16g"})

    from isohyet.plans import ml_queries as MLQ
    from isohyet.plans.registry import QUERIES

    headline = ["event_label", "add_features", "add_features_skew_safe", "schema_profile", "target_correlation", "column_histogram",
                "correlation_matrix_topk", "average_precision", "roc_curve", "threshold_by_fold", "cv_summary",
                "stratified_kfold", "sample_groups", "group_kfold"]
    if os.environ.get("BENCH_MODELS", "1") != "0":
        headline += ["standardize", "smote_oversample", "random_forest", "calibrated_ensemble", "l1_logistic",
                     "permutation_importance", "score"]
    only = os.environ.get("BENCH_QUERIES")
    if only:
        headline = [q for q in only.split(",") if q in QUERIES]
    _ = MLQ  # registered through QUERIES

    # warm-up: JVM, parquet footers, Python workers
    _run(QUERIES["read_panel"](spark, sf))

    times = {}
    for name in headline:
        t0 = time.time()
        _run(QUERIES[name](spark, sf))
        times[name] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_headline_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf).replace("sf", ""), "cpus": cpus}))


if __name__ == "__main__":
    main()
