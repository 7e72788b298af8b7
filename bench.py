"""Headline queries, timed one after the other; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from corpusmill.plans.catalog import QUERIES
from corpusmill.session import local_session

HEADLINE = (
    "prepare_corpus", "dedup_exact_first", "length_stats_by_class", "vocab_richness", "ngram_growth",
    "top_tokens_per_class", "stratified_split", "tfidf_fit", "tfidf_transform", "scale_features",
    "auc_roc", "threshold_sweep", "nb_bernoulli", "cv_grid_multi_metric", "external_eval",
    "logreg_gd", "normalize_standardize", "row_fingerprint", "stream_score", "svm_linear", "svm_kernel", "learning_curve",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "corpusmill-bench")
    spark.range(1000).groupBy("id").count().collect()  # start the executors
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
