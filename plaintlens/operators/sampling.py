"""Exact, repeatable stratified sampling without sorting a whole stratum in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens.operators.profile import value_shares
from plaintlens.session import broadcast_if_small, cut_lineage


def draw_order(id_column: str, seed: int) -> Column:
    """A portable pseudo-random sort key: the same id and seed give the same key anywhere."""
    return F.md5(F.concat_ws("|", F.col(id_column).cast("string"), F.lit(str(seed))))


def stratified_sample(
    df: DataFrame,
    n: int = K.SAMPLE_SIZE,
    category: str = "product_category",
    id_column: str = "complaint_id",
    seed: int = K.SAMPLE_SEED,
    min_per_group: int = 0,
) -> DataFrame:
    """``round(n / N * n_g)`` rows of every group (half to even), the lowest draw keys first.

    ``n >= N`` returns every row. Rows without a category can then survive; otherwise they drop
    out, but still count in N.

    Ranking a group needs its draw order, and one group may hold a third of all rows. So a first
    pass counts rows per (group, leading key digits) with map-side aggregation only, which tells
    the slot where each group's quota runs out. A second pass ranks inside those slots, each
    about 1/65,536 of its group, and finds the last row to take. Both passes read ids and
    categories only. Taking the sample is then a filter behind a join with one row per group:
    no shuffle, however large the sample. Repeated ids across a quota's end are told apart by
    ranking instead.
    """
    key = draw_order(id_column, seed)
    slot = F.substring(key, 1, 4)
    counts = cut_lineage(
        df.groupBy(F.col(category).alias("_g"), slot.alias("_slot")).agg(
            F.count(F.lit(1)).alias("_n")
        )
    )
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if n >= total:
        return df

    edges = broadcast_if_small(cut_lineage(_quota_edges(counts, n / total, min_per_group)))
    draws = df.select(
        F.col(category).alias("_g"), F.col(id_column).alias("_id"), key.alias("_key")
    ).withColumn("_slot", F.substring("_key", 1, 4))
    order = W.partitionBy("_g").orderBy("_key", "_id")
    last = cut_lineage(
        draws.join(edges, "_g")
        .filter(F.col("_slot") == F.col("_edge"))
        .withColumn("_rank", F.row_number().over(order))
        .withColumn("_repeated", F.coalesce(F.lead("_id").over(order) == F.col("_id"), F.lit(False)))
        .filter(F.col("_rank") == F.col("_left"))
        .select("_g", F.struct("_key", "_id").alias("_last"), "_repeated")
    )
    keyed = df.withColumn("_key", key)
    if last.filter("_repeated").isEmpty():
        return (
            keyed.join(broadcast_if_small(last), F.col(category) == F.col("_g"))
            .filter(F.struct(F.col("_key"), F.col(id_column).alias("_id")) <= F.col("_last"))
            .select(*df.columns)
        )
    in_slot = W.partitionBy(category, "_slot").orderBy("_key", id_column)
    return (
        keyed.withColumn("_slot", F.substring("_key", 1, 4))
        .join(edges, F.col(category) == F.col("_g"))
        .filter(F.col("_slot") <= F.col("_edge"))
        .withColumn("_rank", F.row_number().over(in_slot))
        .filter((F.col("_slot") < F.col("_edge")) | (F.col("_rank") <= F.col("_left")))
        .select(*df.columns)
    )


def _quota_edges(counts: DataFrame, fraction: float, min_per_group: int) -> DataFrame:
    """Per group with a quota: the slot in which it runs out and the rows to take from it."""
    quota = F.greatest(
        F.bround(F.sum("_n").over(W.partitionBy("_g")) * F.lit(fraction)).cast("bigint"),
        F.lit(min_per_group),
    )
    before = F.sum("_n").over(W.partitionBy("_g").orderBy("_slot")) - F.col("_n")
    return (
        counts.filter(F.col("_g").isNotNull())
        .select("_g", "_slot", "_n", before.alias("_before"), quota.alias("_quota"))
        # every slot that still has quota left when it starts; the last one is the edge
        .filter(F.col("_before") < F.col("_quota"))
        .groupBy("_g")
        .agg(F.max(F.struct("_slot", F.least(F.col("_quota") - F.col("_before"), "_n"))).alias("e"))
        .select("_g", F.col("e._slot").alias("_edge"), F.col("e.col2").alias("_left"))
    )


def cap_per_category(
    df: DataFrame,
    cap: int = K.CATEGORY_CAP,
    category: str = "product_category",
    id_column: str = "id",
    seed: int = K.SAMPLE_SEED,
) -> DataFrame:
    """At most ``cap`` random rows of each category.

    The constant rank limit lets Spark trim every task to ``cap`` rows per category before the
    shuffle, so a dominant category never gathers in one task.
    """
    order = W.partitionBy(category).orderBy(draw_order(id_column, seed), F.col(id_column))
    return (
        df.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= cap)
        .drop("_rank")
    )


def sample_summary(df: DataFrame, category: str = "product_category") -> DataFrame:
    """Count and percentage per category, largest first."""
    return value_shares(df, category)
