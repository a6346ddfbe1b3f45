"""Exact k-nearest search that skips the parts of the store no nearest vector can lie in.

The store is dealt once into clusters. Centres are the ``centres`` stored vectors of each length
with the smallest hash of their id (a bounded choice: ``TakeOrderedAndProject`` keeps that many
rows per task); every stored vector goes to its nearest centre in one narrow pass with the
centres broadcast (their size is ``centres`` times the lengths, checked), and the table is written
partitioned by cluster, so reading a set of clusters is partition pruning. A grouping with
partial aggregation gives each cluster's size and radius (largest distance to its centre).

A block of questions (bounded by bytes, as in :func:`knn.nearest`) is answered in two scans:

1. each question's closest clusters, until they hold ``k`` vectors, are scanned; the k-th
   distance found bounds the answer from above (no bound when fewer than ``k`` match);
2. a cluster can hold a nearer vector only if ``max(0, |q - c| - radius)^2`` is within that bound
   (triangle inequality); the clusters some question of the block still needs are scanned.

Both scans run the same per-task best-``k`` search as :func:`knn.nearest`, so distances,
rounding, ties (smaller id) and category filters are the same, and so are the results. Lengths
without a centre (none stored) are never matched, as in the plain search. An empty store or no
question gives no rows. :func:`clusters_read` tells which clusters each block read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens.operators.knn import MAX_QUESTION_BYTES, _scan
from plaintlens.session import scratch_path

#: Centres per vector length.
CENTRES = 64
#: Most numbers of all centres together that are broadcast.
MAX_CENTRE_NUMBERS = 4_000_000
#: Slack on the rounded distances of the bound.
_SLACK = 1e-6


def clustered(store: DataFrame, category: str = "product_category", centres: int = CENTRES):
    """(written store with ``cluster``, {cluster: (length, centre, size, radius)})."""
    spark = store.sparkSession
    if category not in store.columns:
        store = store.withColumn(category, F.lit(""))
    store = store.select(
        F.col("id").cast("string").alias("id"), "embedding", F.col(category).alias("category")
    ).where(F.col("embedding").isNotNull())
    lengths = [r[0] for r in store.select(F.size("embedding")).distinct().collect()]
    if len(lengths) * centres * max(lengths, default=0) > MAX_CENTRE_NUMBERS:
        raise ValueError("too many centres to broadcast: lower `centres`")
    table: dict[int, tuple[int, np.ndarray]] = {}
    for length in sorted(lengths):
        picked = (
            store.where(F.size("embedding") == length)
            .orderBy(F.xxhash64("id"), "id")
            .limit(centres)
            .select("embedding")
            .collect()
        )
        for row in picked:
            table[len(table)] = (length, np.array(row[0], dtype="float64"))
    by_length: dict[int, tuple[list[int], np.ndarray]] = {}
    for c, (length, v) in table.items():
        ids, vs = by_length.get(length, ([], []))
        by_length[length] = (ids + [c], list(vs) + [v])
    packed = spark.sparkContext.broadcast(
        {n: (np.array(ids), np.vstack(vs)) for n, (ids, vs) in by_length.items()}
    )

    def assign(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        from plaintlens.operators.knn import _matrix

        for batch in batches:
            lengths_ = pc.list_value_length(batch.column("embedding"))
            for length, (ids, centre) in packed.value.items():
                same = batch.filter(pc.equal(lengths_, length))
                if not same.num_rows:
                    continue
                x = _matrix(same.column("embedding"), length)
                d2 = (x**2).sum(1)[:, None] + (centre**2).sum(1)[None, :] - 2 * x @ centre.T
                near = d2.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        same.column("id"), same.column("embedding"), same.column("category"),
                        pa.array(ids[near], pa.int32()),
                        pa.array(np.sqrt(np.maximum(d2[np.arange(len(x)), near], 0.0))),
                    ],
                    names=["id", "embedding", "category", "cluster", "to_centre"],
                )

    schema = "id string, embedding array<double>, category string, cluster int, to_centre double"
    path = scratch_path(spark, "clustered-store")
    store.withColumn("embedding", F.col("embedding").cast("array<double>")).mapInArrow(
        assign, schema
    ).write.partitionBy("cluster").parquet(path)
    written = spark.read.schema(schema).parquet(path)
    facts = written.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.max("to_centre").alias("radius")
    )
    info = {
        r["cluster"]: (table[r["cluster"]][0], table[r["cluster"]][1], r["size"], r["radius"])
        for r in facts.collect()  # one row a cluster
    }
    return written, info


def _plan(rows, info: dict, k: int):
    """(first clusters, per question: (length, vector)) of one block."""
    first: set[int] = set()
    for r in rows:
        q = np.array(r["embedding"], dtype="float64")
        own = sorted(
            (float(np.sum((q - c) ** 2)), cid, size)
            for cid, (length, c, size, _) in info.items()
            if length == len(q)
        )
        held = 0
        for _, cid, size in own:
            if held >= k:
                break
            first.add(cid)
            held += size
    return first


def _needed(rows, info: dict, bounds: dict, first: set[int]) -> set[int]:
    more: set[int] = set()
    for r in rows:
        q = np.array(r["embedding"], dtype="float64")
        bound = bounds.get(r["question_id"], math.inf)
        for cid, (length, c, _, radius) in info.items():
            if cid in first or cid in more or length != len(q):
                continue
            gap = max(0.0, float(np.sqrt(np.sum((q - c) ** 2))) - radius)
            if gap * gap <= bound + _SLACK:
                more.add(cid)
    return more


_READ: list[tuple[int, int, int]] = []


def clusters_read() -> list[tuple[int, int, int]]:
    """(first scan, second scan, all clusters) of each block of the last search."""
    return list(_READ)


def knn_pruned(
    questions: DataFrame,
    store: DataFrame,
    k: int = K.TOP_K,
    category: str = "product_category",
    centres: int = CENTRES,
    max_question_bytes: int = MAX_QUESTION_BYTES,
) -> DataFrame:
    """The ``k`` nearest stored vectors of each question: question_id, id, distance, rank; the
    same rows as :func:`knn.nearest`."""
    spark = store.sparkSession
    if "filter_category" not in questions.columns:
        questions = questions.withColumn("filter_category", F.lit(""))
    questions = questions.select(
        F.col("question_id").cast("string").alias("question_id"),
        F.coalesce("filter_category", F.lit("")).alias("filter_category"),
        "embedding",
    ).where(F.col("embedding").isNotNull())
    table, info = clustered(store, category, centres)
    size = questions.agg(F.coalesce(F.sum(F.size("embedding")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, math.ceil(size * 8 / max(1, max_question_bytes)))
    if blocks > 1:
        path = scratch_path(spark, "question-blocks")
        questions.withColumn("block", F.pmod(F.xxhash64("question_id"), F.lit(blocks))).write.partitionBy(
            "block"
        ).parquet(path)
        questions = spark.read.parquet(path)
    order = W.partitionBy("question_id").orderBy("distance", "id")
    _READ.clear()
    done = []
    for block in range(blocks):
        own = questions if blocks == 1 else questions.filter(F.col("block") == block)
        rows = own.collect()  # bounded by max_question_bytes
        if not rows or not info:
            continue
        first = _plan(rows, info, k)
        found = _scan(rows, table.where(F.col("cluster").isin(sorted(first))), k)
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        found = _written(found, "pruned-first")
        kth = found.groupBy("question_id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("d"))
        bounds = {r["question_id"]: (r["d"] if r["n"] >= k else math.inf) for r in kth.collect()}
        more = _needed(rows, info, bounds, first)
        _READ.append((len(first), len(more), len(info)))
        if more:
            extra = _scan(rows, table.where(F.col("cluster").isin(sorted(more))), k)
            found = found.drop("rank").unionByName(extra)
            found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            found = _written(found, "pruned-found")
        done.append(found)
    if not done:
        return spark.createDataFrame([], "question_id string, id string, distance double, rank int")
    return reduce(DataFrame.unionByName, done)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
