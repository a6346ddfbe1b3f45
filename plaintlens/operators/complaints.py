"""Filtering, category mapping and cleaning of the complaint table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens.functions import text as T

MAX_MAP_LABELS = 100_000


def product_dimension(
    spark: SparkSession, product_map: Mapping[str, Sequence[str]] = K.PRODUCT_MAP
) -> DataFrame:
    """category -> [labels] turned into one row per label."""
    entries = [
        x
        for category, labels in product_map.items()
        for x in (F.lit(category), F.array(*[F.lit(label) for label in labels]))
    ]
    by_category = spark.range(0, 1, 1, 1).select(
        F.explode(F.create_map(*entries)).alias("product_category", "labels")
    )
    return by_category.select("product_category", F.explode("labels").alias("product"))


def map_categories(
    df: DataFrame, product_map: Mapping[str, Sequence[str]] = K.PRODUCT_MAP
) -> DataFrame:
    """Keep rows with a target product label and add ``product_category``.

    Filter and lookup are one inner join. The dimension is built from an in-memory mapping whose
    size is known here, so the broadcast is bounded; a larger mapping is left to the optimizer.
    """
    dimension = product_dimension(df.sparkSession, product_map)
    if sum(len(labels) for labels in product_map.values()) <= MAX_MAP_LABELS:
        dimension = F.broadcast(dimension)
    return df.join(dimension, "product", "inner")


def with_narrative(df: DataFrame, column: str = "narrative") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~T.is_blank(F.col(column)))


def clean_narratives(
    df: DataFrame, cleaner: Column | None = None, column: str = "narrative"
) -> DataFrame:
    """Add ``cleaned_narrative`` and drop rows that cleaning left empty.

    The cleaned text comes out of a generator that yields nothing for an empty one. A plain
    filter on the new column would be pushed below the projection and the category join, and
    would clean every text a second time, unwanted categories included.
    """
    cleaned = T.clean_text(F.col(column)) if cleaner is None else cleaner
    kept = F.filter(F.array(cleaned), lambda t: F.length(t) > 0)
    return df.select("*", F.explode(kept).alias("cleaned_narrative"))


def openers_shown(df: DataFrame, n: int = 3, column: str = "narrative") -> DataFrame:
    """A few narratives that start with a stock opener, before and after stripping."""
    c = F.col(column)
    return df.filter(T.has_opener(c)).select(
        T.excerpt(c, 160).alias("raw"),
        T.excerpt(T.strip_openers(F.lower(c)), 160).alias("stripped"),
    ).limit(n)
