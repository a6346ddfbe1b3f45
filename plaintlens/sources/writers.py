"""Writers. Overwrites make re-runs idempotent; Spark's commit protocol covers lost tasks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens import schemas as S


def write_cleaned_complaints(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The eleven-column cleaned table. CSV output carries the original headers."""
    if fmt == "csv":
        named = df.select(*[F.col(n).alias(h) for h, n in S.CLEANED_HEADERS.items()])
        (
            named.write.mode("overwrite")
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    else:
        df.select(*S.CLEANED_HEADERS.values()).write.mode("overwrite").parquet(path)


def write_collection(
    store: DataFrame, store_dir: str, collection: str, layout: str = "rebalance"
) -> str:
    """Write a collection as Parquet folders, one per product category.

    ``layout="rebalance"`` shuffles once by category and lets AQE split a dominant category into
    tasks of the advisory size, so files come out evenly sized. ``layout="narrow"`` skips that
    shuffle: each task writes its rows to the categories it holds, at the price of more files.

    Files carry a bloom filter on ``id``: fetching the text of a few hits, or looking up ids,
    then skips the row groups that hold none of them.

    With AQE off, use "narrow": nothing then splits a dominant category.
    """
    category = F.when(F.col("product_category") == "", S.EMPTY_CATEGORY).otherwise(
        F.col("product_category")
    )
    store = store.withColumn("product_category", category)
    path = f"{store_dir}/{collection}"
    if layout == "rebalance":
        store = store.hint("rebalance", "product_category")
    elif layout != "narrow":
        raise ValueError("layout is 'rebalance' or 'narrow'")
    (
        store.write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#id", "true")
        .partitionBy("product_category")
        .parquet(path)
    )
    return path


def write_questions(questions: DataFrame, path: str, per_file: int = 1_000) -> None:
    """Question set as JSON arrays, one file of about ``per_file`` questions each."""
    files = max(1, math.ceil(questions.count() / per_file))
    (
        questions.groupBy(F.pmod(F.xxhash64("id"), F.lit(files)).alias("part"))
        .agg(F.to_json(F.collect_list(F.struct("id", "category", "question"))).alias("value"))
        .write.mode("overwrite")
        .partitionBy("part")
        .text(path)
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("overwrite").json(path)


def save_run(rows: DataFrame, summary: DataFrame, results_dir: str, run_timestamp: str) -> None:
    """Store the rows of a run in its own folder and append its summary to the history."""
    folder = f"runs/run_timestamp={run_timestamp}"
    (
        rows.withColumn("run_timestamp", F.lit(run_timestamp))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_timestamp")
        .json(f"{results_dir}/runs")
    )
    append_history(
        summary.select(
            F.lit(run_timestamp).alias("run_timestamp"), "*", F.lit(folder).alias("results_file")
        ),
        results_dir,
    )


def append_history(lines: DataFrame, results_dir: str) -> None:
    lines.coalesce(1).write.mode("append").option("header", True).csv(f"{results_dir}/history")
