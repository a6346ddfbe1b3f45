"""Frequency tables, coverage, distributions and histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plaintlens.session import cut_lineage


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def value_shares(df: DataFrame, column: str, places: int = 1) -> DataFrame:
    """:func:`value_counts` with each value's percentage of all non-null rows.

    The counts are written once and serve both as rows and for the total, so the table itself
    is scanned a single time and no window gathers all values in one task.
    """
    counts = cut_lineage(
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    )
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        column, "count", F.round(F.col("count") / total * 100, places).alias("pct")
    ).orderBy(F.desc("count"), column)


def align_shares(
    left: DataFrame, right: DataFrame, column: str, left_name: str, right_name: str
) -> DataFrame:
    """Two share tables side by side; a value missing on one side stays null."""
    a = value_shares(left, column).select(column, F.col("pct").alias(left_name))
    b = value_shares(right, column).select(column, F.col("pct").alias(right_name))
    return a.join(b, column, "full_outer")


def presence(df: DataFrame, present: Column) -> DataFrame:
    """Rows with and without, and the percentage with."""
    return df.agg(
        F.count_if(present).alias("n_with"),
        F.count_if(~present).alias("n_without"),
        F.round(F.avg(present.cast("int")) * 100, 1).alias("pct_with"),
    )


def coverage_by(df: DataFrame, key: str, present: Column) -> DataFrame:
    """Per key: rows with, rows in total, percentage with; largest total first."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count_if(present).alias("n_with"), F.count(F.lit(1)).alias("total"))
        .withColumn("pct_with", F.round(F.col("n_with") / F.col("total") * 100, 1))
        .orderBy(F.desc("total"), key)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def describe_numbers(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, linear quartiles and maximum in one pass.

    ``percentile`` merges a value -> count map per task, so its state is bounded by the number
    of distinct values; the callers pass word counts and text lengths.
    """
    q = F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        q.alias("q"),
        F.max(column).alias("max"),
    ).select(
        "count", "mean", "std", "min",
        F.get("q", F.lit(0)).alias("p25"),
        F.get("q", F.lit(1)).alias("p50"),
        F.get("q", F.lit(2)).alias("p75"),
        "max",
    )


def count_outliers(df: DataFrame, column: str, below: int = 5, above: int = 1000) -> DataFrame:
    return df.agg(
        F.count_if(F.col(column) < below).alias("n_below"),
        F.count_if(F.col(column) > above).alias("n_above"),
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Value -> count. Everything below works on this far smaller table."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def histogram(df: DataFrame, column: str, bins: int, clip_at: float | None = None) -> DataFrame:
    """Equal-width bins over the observed range; the maximum belongs to the last bin.

    ``clip_at`` first lowers larger values to that (linear) percentile. Bins without rows are
    left out. When all values are equal the range is widened by one half on both sides. The
    value -> count table is written once; percentile, range and bins all come from it.
    """
    freq = cut_lineage(frequencies(df, column))
    value = F.col("value").cast("double")
    if clip_at is not None:
        upper = freq.agg(F.percentile("value", F.lit(clip_at), F.col("n"))).scalar()
        value = F.least(value, upper)
    freq = freq.select(value.alias("value"), "n")
    bounds = freq.agg(
        F.struct(F.min("value").alias("lowest"), F.max("value").alias("highest"))
    ).scalar()
    flat = F.col("b.lowest") == F.col("b.highest")
    ranged = freq.select("value", "n", bounds.alias("b")).select(
        "value",
        "n",
        F.when(flat, F.col("b.lowest") - 0.5).otherwise(F.col("b.lowest")).alias("lo"),
        F.when(flat, F.col("b.highest") + 0.5).otherwise(F.col("b.highest")).alias("hi"),
    )
    index = F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        ranged.select(
            F.least(index, F.lit(bins - 1)).cast("int").alias("bin"), "lo", width.alias("w"), "n"
        )
        .groupBy("bin")
        .agg(F.sum("n").alias("count"), F.first("lo").alias("lo"), F.first("w").alias("w"))
        .select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_start"), "count")
        .orderBy("bin")
    )


def rank_percentiles(df: DataFrame, column: str, points: Mapping[str, float]) -> DataFrame:
    """Values at the 0-based rank ``floor(n * p)`` of the sorted column, without interpolation.

    The running count goes over the value -> count table only; its single window task holds one
    row per distinct value (text lengths), never one per input row.
    """
    running = frequencies(df, column).select(
        "value",
        "n",
        F.sum("n").over(W.orderBy("value")).alias("upto"),
        F.sum("n").over(W.partitionBy()).alias("total"),
    )
    picks = [
        F.min(F.when(F.col("upto") > F.floor(F.col("total") * F.lit(p)), F.col("value"))).alias(
            name
        )
        for name, p in points.items()
    ]
    return running.agg(
        F.sum("n").alias("n_rows"), F.min("value").alias("min"), *picks,
        F.max("value").alias("max"),
    )


def top_values(df: DataFrame, candidates: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` most frequent values of each candidate column the table really has.

    Counts are reduced per value before ranking, and Spark trims each task's share of the
    ranking to ``n`` rows per column ahead of the shuffle.
    """
    present = [c for c in candidates if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame(
            [], "column string, value string, count bigint, rank int"
        )
    long = df.select(*[F.col(c).cast("string").alias(c) for c in present]).unpivot(
        [], present, "column", "value"
    )
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    order = W.partitionBy("column").orderBy(F.desc("count"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
