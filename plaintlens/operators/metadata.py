"""Checks on pre-embedded tables, and their flattening into a store."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintlens import constants as K
from plaintlens.functions.vector import prefix
from plaintlens.operators.profile import rank_percentiles

LENGTH_POINTS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
# the chunk index of a well-formed id: only digits after the last underscore
INDEX_IN_ID = r"(?s)^.*_(\p{Nd}+)$"


def flatten_metadata(df: DataFrame) -> DataFrame:
    """id, document, embedding and one flat column per metadata field.

    The two counters become integers with 0 for null, every other field text with "" for null; a
    null struct counts as all fields null.
    """
    fields = [f.name for f in df.schema["metadata"].dataType.fields]
    flat = []
    for name in fields:
        if name in K.METADATA_INT_FIELDS:
            value = F.coalesce(F.col(f"metadata.{name}").cast("int"), F.lit(0))
        else:
            value = F.coalesce(F.col(f"metadata.{name}").cast("string"), F.lit(""))
        flat.append(value.alias(name))
    return df.select(
        F.col("id").cast("string").alias("id"),
        F.col("document").cast("string").alias("document"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        *flat,
    )


def category_counts(df: DataFrame, category: str = "product_category") -> DataFrame:
    """Rows per category, a missing category counted as ""."""
    return df.groupBy(F.coalesce(F.col(category), F.lit("")).alias(category)).agg(
        F.count(F.lit(1)).alias("count")
    )


def reconcile(source: DataFrame, store: DataFrame) -> DataFrame:
    """Rows ingested against distinct ids stored; a difference means duplicate ids."""
    ingested = source.agg(F.count(F.lit(1))).scalar()
    return store.agg(
        ingested.alias("rows_ingested"),
        F.count(F.lit(1)).alias("rows_stored"),
        F.countDistinct("id").alias("distinct_ids"),
    ).withColumn("has_duplicates", F.col("distinct_ids") != F.col("rows_ingested"))


def duplicate_ids(df: DataFrame) -> DataFrame:
    return df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def hidden_counters(df: DataFrame) -> DataFrame:
    """Rows whose null chunk counters flattening turns into 0."""
    return df.agg(
        *[
            F.count_if(F.col(f"metadata.{name}").isNull()).alias(f"null_{name}")
            for name in K.METADATA_INT_FIELDS
        ]
    )


def metadata_keys(df: DataFrame, column: str = "metadata") -> DataFrame:
    """Per key: rows that have it, rows with a value, share of rows, value types seen.

    Works on a struct (every key is always present), a map, or JSON objects kept as text.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        return _struct_keys(df, column, kind)
    is_json = isinstance(kind, T.StringType)
    entries = F.map_entries(
        F.from_json(column, "map<string,variant>") if is_json else F.col(column)
    )

    def described(e):
        if is_json:
            found = F.nullif(F.schema_of_variant(e["value"]), F.lit("VOID"))
        else:
            found = F.when(e["value"].isNotNull(), F.typeof(e["value"]))
        # the kind only: nested fields differ from row to row
        return F.struct(e["key"].alias("key"), F.regexp_replace(found, "(?s)<.*", "").alias("type"))

    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.select(F.inline(F.transform(entries, described)))
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("present_in"),
            F.count("type").alias("with_value"),
            F.array_join(F.sort_array(F.collect_set("type")), ",").alias("value_types"),
        )
        .withColumn("coverage_pct", F.round(F.col("present_in") / total * 100, 1))
    )


def _type_name(kind: T.DataType) -> str:
    return kind.simpleString().upper()


def _struct_keys(df: DataFrame, column: str, kind: T.StructType) -> DataFrame:
    """The fields are known, so each is one counter of a single-row aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(column)[f.name]).alias(f.name) for f in kind.fields],
    )
    rows = [
        F.struct(
            F.lit(f.name).alias("key"),
            F.col("_rows").alias("present_in"),
            F.col(f.name).alias("with_value"),
            F.when(F.col(f.name) > 0, F.lit(_type_name(f.dataType)))
            .otherwise(F.lit(""))
            .alias("value_types"),
            F.when(F.col("_rows") > 0, F.lit(100.0)).alias("coverage_pct"),
        )
        for f in kind.fields
    ]
    return counted.select(F.inline(F.array(*rows)))


def id_pattern_check(df: DataFrame) -> DataFrame:
    """Does every id read ``{complaint_id}_{chunk_index}``, and agree with the metadata?"""
    parsed = df.select(
        "id",
        F.regexp_extract("id", INDEX_IN_ID, 1).alias("digits"),
        F.col("metadata.chunk_index").alias("stated"),
    )
    fits = F.col("digits") != ""
    differs = fits & F.col("stated").isNotNull() & (
        F.col("digits").try_cast("bigint") != F.col("stated")
    )
    return parsed.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(~fits).alias("unexpected_format"),
        F.count_if(F.coalesce(differs, F.lit(False))).alias("mismatches"),
    )


def id_mismatches(df: DataFrame, n: int = 5) -> DataFrame:
    """The first few ids whose index differs from the metadata."""
    digits = F.regexp_extract("id", INDEX_IN_ID, 1)
    return (
        df.select(
            "id",
            digits.try_cast("bigint").alias("index_in_id"),
            F.col("metadata.chunk_index").alias("index_in_metadata"),
        )
        .filter(F.col("index_in_id") != F.col("index_in_metadata"))
        .orderBy("id")
        .limit(n)
    )


def complaint_of(id_column: str = "id"):
    """Everything before the last underscore; an id without one stands for itself."""
    return F.regexp_replace(F.col(id_column), r"(?s)_[^_]*$", "")


def chunks_per_complaint(df: DataFrame) -> DataFrame:
    """Distinct complaints and the spread of chunks over them."""
    per = df.groupBy(complaint_of().alias("complaint")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.sum("n").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_complaints"),
        F.min("n").alias("min_chunks"),
        F.max("n").alias("max_chunks"),
        F.round(F.avg("n"), 2).alias("mean_chunks"),
    )


def document_lengths(
    df: DataFrame, column: str = "document", points: Mapping[str, float] = LENGTH_POINTS
) -> DataFrame:
    return rank_percentiles(df.select(F.length(column).alias("_len")), "_len", points)


def dimension_check(df: DataFrame, expected: int = K.EMBEDDING_DIM) -> DataFrame:
    """Rows per vector length, with whether it is the expected one."""
    return (
        df.groupBy(F.size("embedding").alias("dim"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("as_expected", F.col("dim") == expected)
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows to look at: shortened text, vector length and first five values."""
    return df.select(
        "id",
        F.concat(
            F.substring("document", 1, 200),
            F.when(F.length("document") > 200, F.lit("...")).otherwise(F.lit("")),
        ).alias("document"),
        F.size("embedding").alias("dim"),
        prefix(F.col("embedding"), 5).alias("first_values"),
        *(["metadata"] if "metadata" in df.columns else []),
    ).limit(n)
