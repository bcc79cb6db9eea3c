"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textlake.catalog import QUERIES  # noqa: E402

HEADLINES = [
    "clean_text",
    "remove_stopwords",
    "bag_of_words",
    "tfidf",
    "encode_sequences",
    "nb_predict",
    "sentiment_summary",
    "top_entities",
    "most_similar",
    "retrieve_top_k",
    "search_pages",
    "token_blocks",
    "ngram_counts",
    "perplexity",
    "numeric_summary",
    "quantize_int8",
    "token_windows",
    "chunk_recursive",
    "extract_entities",
    "fit_logistic_regression",
    "lda_topics",
    "bpe_train",
    "encode_features",
    "lemmatize_documents",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("textlake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    names = sys.argv[1:] or HEADLINES
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
