"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plaintlens.plans.queries import QUERIES  # noqa: E402
from plaintlens.session import build_session, clear_scratch  # noqa: E402

HEADLINE = [
    "product_counts",
    "category_filter_map",
    "word_count_describe",
    "word_count_histogram",
    "strip_openers",
    "clean_noise",
    "clean_noise_pages",
    "normalize_tokens",
    "stratified_sample",
    "chunks",
    "chunk_stats",
    "chunk_sweep",
    "category_cap",
    "hash_embedding",
    "metadata_keys",
    "ingest_reconcile",
    "top_values",
    "knn_topk",
    "knn_filtered",
    "text_retrieval",
    "judge_parse",
    "eval_summary",
    "resume_rows",
    "batch_answers",
    "build_manifest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cpus, app="bench")
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(1).collect()  # start the JVM side
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        # the noop sink computes every row and column without moving them to the driver
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
