"""Corpus preparation: documents -> token windows, one stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plaintlens.llm.common import read
from plaintlens.llm.stages import STAGES
from plaintlens.session import scratch_path

#: Byte-exact suffix comparison, fingerprints and learned weights have no SQL form; the stages are
#: tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each result is written as Parquet and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
