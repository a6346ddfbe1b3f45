"""Bounded-batch ingest of a growing folder of pre-embedded Parquet files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from plaintlens import schemas as S
from plaintlens.operators.metadata import flatten_metadata


def ingest_available(
    spark: SparkSession,
    landing_dir: str,
    store_path: str,
    checkpoint_path: str,
    files_per_batch: int = 1,
) -> StreamingQuery:
    """Flatten and append every file not seen yet, ``files_per_batch`` files at a time.

    The work is narrow and stateless, so memory stays bounded by one batch; the checkpoint
    remembers which files are done, so a restart neither skips nor repeats any.
    """
    landed = (
        spark.readStream.schema(S.PREBUILT)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing_dir)
    )
    return (
        flatten_metadata(landed)
        .writeStream.format("parquet")
        .partitionBy("product_category")
        .option("path", store_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
