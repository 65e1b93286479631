"""Time the headline queries: one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES choose what runs."""

from __future__ import annotations

import json
import os
import time

from scoreloom import catalog
from scoreloom.session import build_session

HEADLINE = (
    "scalar_descriptors hashed_ngram_bits char_ngram_bits pattern_key_bits feature_assemble "
    "distributed_rank stratified_split stratified_kfold resample_over resample_under "
    "median_impute standardize anova_f chi2_score mutual_info_binned feature_topk "
    "gaussian_nb family_comparison knn_classify metric_row roc_auc "
    "view_validation top4_view_ensemble progression_deltas "
    "rf_baseline decision_tree logreg gbt"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    queries = catalog.queries()
    times = {}
    for name in names:
        start = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
