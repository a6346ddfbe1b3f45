"""The stages of the corpus pipeline: (name, function of (spark, docs, sf_dir)).

All but the last return the columns of ``docs``. Every stage takes nulls, repeated rows, empty
tables and further columns as its operator does; rows without a doc_id are never dropped as near
duplicates, for nothing tells them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens.llm import exact_dedup, quality_classifier, suffix_dedup
from plaintlens.llm.common import read, written
from plaintlens.llm.packing import pack_digests
from plaintlens.llm.simhash import simhash_components


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality_classifier.kept_documents(docs, read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest doc_id."""
    return exact_dedup.kept_documents(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near duplicates by the operator of op2 with its contract (3-word shingles, at most
    3 differing bits, linked transitively): of each component the rows with its smallest doc_id
    stay (repeated rows of that doc_id all stay, they are one document); rows without a doc_id
    always stay.

    Rows get a key once (written), the operator links those keys, and rows are kept or dropped by
    key. The choice per component is a grouping with map-side partial minima, and rows meet it
    on (component, doc_id), so one component holding a third of all rows lands in no single
    task. Empty input: empty output.
    """
    row, comp = "__near_row", "__near_component"
    keyed = written(docs.withColumn(row, F.monotonically_increasing_id()), "near-keyed")
    linked = simhash_components(keyed.select(F.col(row).alias("doc_id"), F.col("text")))
    owners = linked.select(F.col("doc_id").alias(row), F.col("component_id").alias(comp)).join(
        keyed.select(row, F.col("doc_id").cast("long").alias("id")), row
    )
    smallest = owners.where(F.col("id").isNotNull()).groupBy(comp).agg(F.min("id").alias("id"))
    chosen = owners.join(smallest, [comp, "id"], "left_semi").select(row)
    named = keyed.join(chosen, row, "left_semi").where(F.col("doc_id").isNotNull())
    return named.unionByName(keyed.where(F.col("doc_id").isNull())).drop(row)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go from the text; n_chars follows. A document of
    which nothing is left goes."""
    return suffix_dedup.kept_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of at most 2,048 tokens, one row a piece."""
    import public_tokenizers

    return pack_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash", near_stage),
    ("suffix_dedup", suffix_stage),
    ("packing", packing_stage),
]
