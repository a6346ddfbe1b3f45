"""Readers. Each returns a lazy DataFrame; Catalyst prunes columns and pushes filters down."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from plaintlens import schemas as S


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` with their columns found by header name, in any order a file has.

    Narratives hold quotes and line breaks, and multiLine makes a file unsplittable: one task reads
    one file. Convert a large export once with :func:`convert_raw_csv` and read that.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        first = spark.read.text(file).head()  # reads the file's first line
        if first is not None:
            names = tuple(next(csv.reader([first.value.removeprefix("\ufeff")])))
            layouts.setdefault(names, []).append(file)
    frames = [
        spark.read.schema(StructType([StructField(n, StringType()) for n in names]))
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(files)
        for names, files in layouts.items()
    ]
    if not frames:
        raise ValueError(f"no CSV file with a header below {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _by_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Pick columns by header, null the usual missing texts, type the id and the date."""
    out = []
    for header, name in headers.items():
        cell = F.col(f"`{header}`")
        value = F.when(~cell.isin(S.MISSING_TEXTS), cell)
        if name == "complaint_id":
            value = value.cast("bigint")
        elif name == "date_received":
            value = F.try_to_date(value)  # an unreadable date is null, see unreadable_dates
        out.append(value.alias(name))
    return df.select(*out)


def read_raw_complaints(spark: SparkSession, path: str) -> DataFrame:
    """The nine needed columns of the raw complaint export (file or folder of CSV files)."""
    return _by_headers(_read_csv(spark, path), S.RAW_HEADERS)


def unreadable_dates(spark: SparkSession, path: str) -> DataFrame:
    """How many date cells of raw CSV files hold something that is no date."""
    cell = F.col("`Date received`")
    stated = ~cell.isin(S.MISSING_TEXTS) & F.try_to_date(cell).isNull()
    return _read_csv(spark, path).agg(F.count_if(stated).alias("unreadable_dates"))


def convert_raw_csv(spark: SparkSession, path: str, target: str) -> None:
    """Raw CSV files -> Parquet, once; later reads split and prune columns."""
    read_raw_complaints(spark, path).write.mode("overwrite").parquet(target)


def read_cleaned_complaints(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return _by_headers(_read_csv(spark, path), S.CLEANED_HEADERS)
    return spark.read.parquet(path)


def read_embeddings(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Every Parquet file below ``path``; name columns to leave the vectors on disk."""
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    return df.select(*columns) if columns else df


def file_profile(df: DataFrame) -> DataFrame:
    """Files behind a scan with their size and row count; reads no data column."""
    return (
        df.select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("file_name")
        .agg(F.max("file_size").alias("file_size"), F.count(F.lit(1)).alias("n_rows"))
    )


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row: number of files, bytes, rows, columns and the column list."""
    return file_profile(df).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(df.schema.simpleString()).alias("schema"),
    )


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """Question set kept as a JSON array, or as a folder of such files."""
    return (
        spark.read.schema(S.QUESTIONS)
        .option("multiLine", True)
        .json(path)
        .select("id", "category", "question")
    )


def read_results_document(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a results document that nests them under ``rows``."""
    document = f"rows array<struct<{_as_struct(S.EVALUATION_ROWS)}>>"
    return spark.read.schema(document).option("multiLine", True).json(path).selectExpr(
        "inline(rows)"
    )


def _as_struct(ddl: str) -> str:
    return StructType.fromDDL(ddl).simpleString()[len("struct<") : -1]


def read_runs(spark: SparkSession, results_dir: str) -> DataFrame:
    """All saved runs; ``run_timestamp`` is the partition column, kept as text."""
    schema = f"{S.EVALUATION_ROWS}, run_timestamp string"
    return spark.read.schema(schema).json(f"{results_dir}/runs")


def newest_stamp(spark: SparkSession, results_dir: str) -> str | None:
    """Time stamp of the newest saved run, from the history: one short line a run."""
    return read_history(spark, results_dir).agg(F.max("run_timestamp")).first()[0]


def latest_run(spark: SparkSession, results_dir: str) -> DataFrame:
    """Rows of the newest run; only its folder is read. ISO time stamps order as text."""
    newest = newest_stamp(spark, results_dir)
    return read_runs(spark, results_dir).filter(F.col("run_timestamp") == F.lit(newest))


def read_history(spark: SparkSession, results_dir: str) -> DataFrame:
    """One line per saved run."""
    return spark.read.schema(S.HISTORY).option("header", True).csv(f"{results_dir}/history")


def open_collection(
    spark: SparkSession, store_dir: str, collection: str, schema: StructType | None = None
) -> DataFrame:
    """A stored collection; a store without rows has no file to infer from and needs ``schema``.

    Categories stay the text that was written: "001" is no number, and "" is not null. A filter on
    them still picks folders.
    """
    path = f"{store_dir}/{collection}"
    schema = schema or spark.read.parquet(path).schema
    fields = [
        StructField(f.name, StringType() if f.name == "product_category" else f.dataType)
        for f in schema.fields
    ]
    store = spark.read.schema(StructType(fields)).parquet(path)
    category = F.col("product_category")
    category = F.when(category == S.EMPTY_CATEGORY, "").otherwise(category)
    return store.withColumn("product_category", category)


def collection_size(store: DataFrame) -> DataFrame:
    return store.agg(F.count(F.lit(1)).alias("n_chunks"))


def lookup_ids(store: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Stored rows by id; the id list reaches the Parquet scan as a pushed filter."""
    return store.filter(F.col("id").isin(list(ids)))
