"""Chunk tables: one row per chunk, and the parameter sweep over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens.functions.chunk import let, split_cleaned, split_text
from plaintlens.functions.text import excerpt, is_blank


def chunk_table(
    df: DataFrame,
    text_column: str = "cleaned_narrative",
    id_column: str = "complaint_id",
    category: str = "product_category",
    size: int = K.CHUNK_SIZE,
    overlap: int = K.CHUNK_OVERLAP,
    cleaned: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Split every non-blank text; a narrow map, no shuffle and no Python worker.

    ``cleaned=True`` promises single-spaced text without line breaks and uses the two separators
    that can occur there; pass False for raw text. The generator takes the split expression
    itself, so each text is split exactly once.
    """
    split = split_cleaned if cleaned else split_text

    def rows(pieces: Column) -> Column:
        return F.transform(
            pieces,
            lambda piece, i: F.struct(
                i.alias("chunk_index"),
                F.size(pieces).alias("total_chunks"),
                piece.alias("chunk_text"),
            ),
        )

    return df.filter(~is_blank(F.col(text_column))).select(
        F.col(id_column).cast("string").alias("complaint_id"),
        F.col(category).cast("string").alias("product_category"),
        F.inline(let(split(F.col(text_column), size, overlap), rows)),
        *keep,
    )


def chunk_id() -> Column:
    return F.concat_ws("_", "complaint_id", F.col("chunk_index").cast("string"))


def chunk_sweep(
    df: DataFrame,
    candidates: Sequence[tuple[int, int]] = tuple(K.SWEEP_CANDIDATES),
    text_column: str = "cleaned_narrative",
) -> DataFrame:
    """Chunk counts and lengths for several (size, overlap) settings.

    Every text is split once per setting inside one scan and reduced to three numbers before the
    only shuffle. Averages per complaint divide by all complaints, split or not.
    """
    measures = []
    for size, overlap in candidates:
        chunks = split_cleaned(F.col(text_column), size, overlap)
        measures.append(
            F.struct(
                F.lit(size).alias("chunk_size"),
                F.lit(overlap).alias("chunk_overlap"),
                F.when(
                    ~is_blank(F.col(text_column)), F.transform(chunks, F.length)
                ).alias("lengths"),
            )
        )
    return (
        df.select(F.inline(F.array(*measures)))
        .groupBy("chunk_size", "chunk_overlap")
        .agg(
            F.sum(F.coalesce(F.size("lengths"), F.lit(0))).alias("total_chunks"),
            F.count(F.lit(1)).alias("n_complaints"),
            F.sum(
                F.coalesce(F.aggregate("lengths", F.lit(0), lambda a, x: a + x), F.lit(0))
            ).alias("chars"),
        )
        .select(
            "chunk_size",
            "chunk_overlap",
            "total_chunks",
            F.round(F.col("total_chunks") / F.col("n_complaints"), 2).alias(
                "avg_chunks_per_complaint"
            ),
            F.round(F.try_divide("chars", "total_chunks"), 1).alias("avg_chunk_length"),
        )
        .orderBy("chunk_size")
    )


def first_multichunk(chunks: DataFrame, id_order: Column | None = None) -> DataFrame:
    """All chunks of the first complaint that has several; no rows when there is none."""
    order = F.col("complaint_id") if id_order is None else id_order
    first = (
        chunks.filter(F.col("total_chunks") > 1)
        .agg(F.min(F.struct(order.alias("o"), F.col("complaint_id").alias("id")))["id"])
        .scalar()
    )
    return chunks.filter(F.col("complaint_id") == first).select(
        "complaint_id", "chunk_index", "total_chunks", excerpt(F.col("chunk_text"), 200).alias("shown")
    )
