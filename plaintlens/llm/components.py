"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import written


def connected_components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """(a, b) long pairs -> (node, root), the root being the smallest node of the component.

    A round links every node's larger neighbours, then its smaller ones, to the smallest node it
    knows; the number of rounds grows with the logarithm of the longest path. Edges never grow in
    number. A node's neighbours are not gathered: their minimum is aggregated map-side, and the
    join that hands it on can be split when a node has very many. Each table of a round has
    ``files`` files at most, if given.
    """
    edges = written(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
        files,
    )
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(written(least, "least", files), "a").filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        large = written(large.filter("a <> b").distinct(), "large", files)
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least", files)
        small = large.join(least, "a")
        small = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        edges = written(small, "edges", files)
        # done when every edge leads straight to a root
        if edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
