"""End-to-end jobs. Each costly stage is written once and read back by the next."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens.operators import (
    chunking,
    complaints,
    evaluation,
    inference,
    knn,
    metadata,
    sampling,
)
from plaintlens.operators.embedding import hash_embed
from plaintlens.operators.retrieval import check_questions, retrieve
from plaintlens.session import cut_lineage, first_rows, scratch_path
from plaintlens.sources import readers, writers

Embedder = Callable[[DataFrame], DataFrame]


def prepare_complaints(raw: DataFrame, product_map=K.PRODUCT_MAP) -> DataFrame:
    """Raw table -> target categories, non-blank narratives, cleaned text."""
    kept = complaints.with_narrative(complaints.map_categories(raw, product_map))
    return complaints.clean_narratives(kept)


def to_store(chunks: DataFrame, embed: Embedder = hash_embed) -> DataFrame:
    """Chunk table -> minimal store layout."""
    return embed(chunks).select(
        chunking.chunk_id().alias("id"),
        F.col("chunk_text").alias("document"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        "complaint_id",
        "product_category",
        F.col("chunk_index").cast("int").alias("chunk_index"),
        F.col("total_chunks").cast("int").alias("total_chunks"),
    )


def build_sample_store(
    spark: SparkSession,
    cleaned: DataFrame,
    output_dir: str,
    collection: str = "complaints_sample",
    sample_size: int = K.SAMPLE_SIZE,
    size: int = K.CHUNK_SIZE,
    overlap: int = K.CHUNK_OVERLAP,
    seed: int = K.SAMPLE_SEED,
    embed: Embedder = hash_embed,
    model_name: str = "hashing",
    input_path: str = "",
) -> DataFrame:
    """Sample, chunk, embed, store; returns the one-row manifest (also written as JSON).

    Sampled ids (sorted) and rows per category are tables that the manifest names: any number fits.
    ``cleaned`` should be a stored table: sampling first reads its ids and categories, then the
    sampled rows.
    """
    started = datetime.now(timezone.utc)
    sampled_path = f"{output_dir}/{collection}_sampled"
    sampling.stratified_sample(cleaned, sample_size, seed=seed).select(
        "complaint_id", "product_category", "cleaned_narrative"
    ).write.mode("overwrite").parquet(sampled_path)
    sampled = spark.read.parquet(sampled_path)
    chunks = chunking.chunk_table(sampled, size=size, overlap=overlap)
    store_path = writers.write_collection(to_store(chunks, embed), output_dir, collection)

    ids_path = f"{output_dir}/{collection}_sampled_ids"
    counts_path = f"{output_dir}/{collection}_category_counts"
    ids = sampled.select(F.col("complaint_id").cast("string").alias("complaint_id"))
    ids.orderBy("complaint_id").write.mode("overwrite").parquet(ids_path)
    counts = _counted(sampled.groupBy("product_category").count(), counts_path)
    taken = F.coalesce(F.sum("count"), F.lit(0)).alias("sample_size_actual")
    manifest = counts.agg(taken).select(
        F.lit(input_path).alias("input_path"),
        F.lit(output_dir).alias("output_dir"),
        F.lit(collection).alias("collection_name"),
        F.lit(sample_size).alias("sample_size_requested"),
        "sample_size_actual",
        spark.read.parquet(store_path)
        .agg(F.count(F.lit(1)))
        .scalar()
        .alias("num_chunks"),
        F.lit(size).alias("chunk_size"),
        F.lit(overlap).alias("chunk_overlap"),
        F.lit(model_name).alias("embedding_model"),
        F.lit(seed).alias("random_state"),
        F.lit(counts_path).alias("category_counts_path"),
        F.lit(ids_path).alias("sampled_ids_path"),
        F.lit((datetime.now(timezone.utc) - started).total_seconds()).alias("elapsed_seconds"),
    )
    writers.write_manifest(manifest, f"{output_dir}/{collection}_manifest")
    return spark.read.json(f"{output_dir}/{collection}_manifest")


def _counted(counts: DataFrame, path: str) -> DataFrame:
    """Rows per category as a table of its own, whatever their number."""
    counts.write.mode("overwrite").parquet(path)
    return counts.sparkSession.read.parquet(path)


def ingest_embeddings(
    spark: SparkSession,
    source: DataFrame,
    output_dir: str,
    collection: str = "complaints_full",
    limit_rows: int | None = None,
    input_path: str = "",
    layout: str = "rebalance",
) -> DataFrame:
    """Pre-embedded table -> store without embedding again; returns the one-row manifest."""
    started = datetime.now(timezone.utc)
    counts_path = f"{output_dir}/{collection}_category_counts"
    taken, n_source = source, F.lit(None)
    if limit_rows is not None:
        if limit_rows < 0:
            raise ValueError("limit_rows must not be negative")
        total = source.count()
        n_source = F.lit(total)
        if limit_rows < total:
            taken = first_rows(source, limit_rows)
    flat = metadata.flatten_metadata(taken)
    writers.write_collection(flat, output_dir, collection, layout)
    # what follows reads the store's ids and categories, never the source again
    store = readers.open_collection(spark, output_dir, collection, flat.schema)
    category = F.coalesce("product_category", F.lit("")).alias("product_category")
    counts = _counted(store.groupBy(category).count(), counts_path)
    n_ids = store.agg(F.countDistinct("id")).scalar()
    ingested = F.coalesce(F.sum("count"), F.lit(0)).alias("rows_ingested")
    manifest = counts.agg(ingested).select(
        F.lit(input_path).alias("input_path"),
        F.lit(output_dir).alias("output_dir"),
        F.lit(collection).alias("collection_name"),
        F.coalesce(n_source.cast("bigint"), "rows_ingested").alias("rows_in_source_file"),
        "rows_ingested",
        n_ids.alias("final_collection_count"),
        F.lit(counts_path).alias("category_counts_path"),
        F.lit(limit_rows).cast("bigint").alias("limit_rows"),
        F.lit((datetime.now(timezone.utc) - started).total_seconds()).alias("elapsed_seconds"),
        (F.col("rows_ingested") != n_ids).alias("has_duplicate_ids"),
    )
    writers.write_manifest(manifest, f"{output_dir}/{collection}_manifest")
    return spark.read.json(f"{output_dir}/{collection}_manifest")


def evaluate_run(
    spark: SparkSession,
    questions: DataFrame,
    store: DataFrame,
    make_generator: inference.ClientFactory,
    make_judge: inference.ClientFactory,
    results_dir: str | None = None,
    top_k: int = K.TOP_K,
    previous: DataFrame | None = None,
    embed: Embedder | None = None,
    run_timestamp: str | None = None,
    parallelism: int | None = None,
    organisation: str = K.DEFAULT_ORGANISATION,
    settings: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Questions (id, category, question) -> (result rows, summary).

    Rows finished in ``previous`` are reused. No category filter is applied. Replies are
    written to the shared folder before they are used again, so no later stage repeats a call.
    """
    stamp = run_timestamp or datetime.now(timezone.utc).isoformat()
    reused = None
    if previous is not None:
        questions, reused = evaluation.split_resume(questions, previous)
    asked = questions.select(F.col("id").alias("question_id"), "category", "question")
    checked = cut_lineage(check_questions(asked))
    valid = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    embedded = cut_lineage((embed or (lambda df: hash_embed(df, "question")))(valid))
    refused = knn.incomparable(embedded, store)
    valid = valid.join(refused, "question_id", "left_anti")
    found = embedded.join(refused, "question_id", "left_anti")
    hits = retrieve(valid.drop("category"), store, top_k, lambda _: found)
    prompts = inference.with_prompts(inference.with_sources(valid, hits), organisation)

    answered = _written(
        inference.generate_answers(prompts, make_generator, parallelism=parallelism), "answers"
    )
    judged = _written(
        inference.judge_answers(answered, make_judge, parallelism=parallelism), "judged"
    )
    rows = evaluation.evaluation_rows(judged).unionByName(
        evaluation.failed_rows(
            checked.join(refused.withColumnRenamed("reject_reason", "_why"), "question_id", "left")
            .withColumn("reject_reason", F.coalesce("reject_reason", "_why"))
            .drop("_why")
            .filter(F.col("reject_reason").isNotNull())
        )
    )
    if reused is not None:
        rows = rows.unionByName(reused.select(*rows.columns))
    summary = evaluation.summarize(rows)
    if results_dir:
        writers.save_run(rows, summary, results_dir, stamp)
        described = {
            "run_timestamp": stamp,
            "top_k": top_k,
            "num_resumed": 0 if reused is None else reused.count(),
            **(settings or {}),
        }
        spark.createDataFrame([(json.dumps(described),)], "value string").coalesce(
            1
        ).write.mode("append").text(f"{results_dir}/settings")
    return rows, summary


def resume_source(
    spark: SparkSession, results_dir: str, run_timestamp: str | None = None
) -> DataFrame:
    """Rows of the named run, or of the newest one."""
    if run_timestamp is None:
        return readers.latest_run(spark, results_dir)
    return readers.read_runs(spark, results_dir).filter(F.col("run_timestamp") == run_timestamp)


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
