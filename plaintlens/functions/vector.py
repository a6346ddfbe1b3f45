"""Vector expressions: dimension checks, distances, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance; elements are widened to double first."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def similarity_score(distance: Column) -> Column:
    """``1 - distance``; for unit vectors this is ``2 * cosine - 1``."""
    return F.round(F.lit(1.0) - distance, 4)


def cosine_from_distance(distance: Column) -> Column:
    """Cosine similarity of two unit vectors from their squared distance."""
    return F.round(F.lit(1.0) - distance / 2, 4)


def unit(v: Column) -> Column:
    """Scale to length one; a zero vector stays as it is."""
    norm = F.sqrt(
        F.aggregate(v, F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    )
    return F.when(norm == 0, v).otherwise(
        F.transform(v, lambda x: (x.cast("double") / norm).cast("float"))
    )


def prefix(v: Column, n: int) -> Column:
    return F.slice(v, 1, n)
