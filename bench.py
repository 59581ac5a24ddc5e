"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from gramline.queries import QUERIES

HEADLINE = [
    "read_labelled_csv", "read_labelled_csv_cut", "register_dataset", "filter_min_class_frequency",
    "filter_known_labels", "tokenize_space", "remove_stopwords", "stem_tokens", "prepare_text", "char_wb_ngrams",
    "term_frequency", "document_frequency", "document_frequency_of_text", "tfidf", "tfidf_range_a", "tfidf_range_b",
    "tfidf_transform", "text_features", "stratified_split", "shuffled_split", "shuffled_split_lineitem",
    "stratified_kfold", "classification_report", "bandit_keep", "best_trial", "latest_model", "parse_requests",
    "rank_scores", "fit_random_forest", "train_a", "train_b", "score_batch", "score_stream_requests",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    tasks = str(2 * int(cpus)) if cpus.isdigit() else "16"
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gramline-bench")
        .config("spark.sql.shuffle.partitions", tasks)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    result = {"metric": "headline queries, total wall clock", "value": round(sum(seconds.values()), 3), "unit": "sec"}
    print(json.dumps({**result, "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
