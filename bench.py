"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from twinscope.plans import catalog
from twinscope.sources.scratch import clear_scratch

HEADLINE = [
    "profile_head",
    "mirrored_pairs",
    "question_length_stats",
    "balanced_sample",
    "norm_punct",
    "norm_lemma",
    "clean_pairs",
    "feat_word_share",
    "feat_cosine",
    "feat_bigrams",
    "feat_readability",
    "feat_wratio",
    "feat_partial_ratio",
    "pair_features",
    "pair_features_documents",
    "unique_questions",
    "vocabulary_index",
    "encode_docs",
    "nearest_word",
    "feat_word2vec_diff",
    "stratified_folds",
    "standardize",
    "eval_auc",
    "model_bernoulli_nb",
    "score_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        # One machine: a local folder is shared by all tasks.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="twinscope-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    # The queries above share written tables (lemmas, cleaned texts). Once more without any of them:
    clear_scratch(spark)
    start = time.perf_counter()
    catalog.QUERIES["pair_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    cold = round(time.perf_counter() - start, 3)
    n_pairs = catalog.QUERIES["drop_null_pairs"](spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "feature_pairs": n_pairs,
                "feature_pairs_per_second": round(n_pairs / seconds["pair_features"], 1),
                "feature_pairs_per_second_cold": round(n_pairs / cold, 1),
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
