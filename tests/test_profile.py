import numpy as np
import pytest
from pyspark.sql import functions as F

from plaintlens.operators import profile


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(1, 400, 501).tolist() + [5000]
    return values, spark.createDataFrame([(int(v),) for v in values], "v int")


def test_value_counts_drop_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    assert [tuple(r) for r in profile.value_counts(df, "x").collect()] == [("a", 2), ("b", 1)]
    assert [r.pct for r in profile.value_shares(df, "x").collect()] == [66.7, 33.3]


def test_describe(numbers):
    values, df = numbers
    r = profile.describe_numbers(df, "v").first()
    assert r["count"] == len(values)
    assert r["std"] == pytest.approx(np.std(values, ddof=1))
    assert [r.p25, r.p50, r.p75] == pytest.approx(np.percentile(values, [25, 50, 75]))


@pytest.mark.parametrize("bins, clip", [(40, None), (80, 0.99)])
def test_histogram(numbers, bins, clip):
    values, df = numbers
    if clip:
        values = np.clip(values, None, np.percentile(values, clip * 100))
    counts, edges = np.histogram(values, bins=bins)
    got = {r.bin: r for r in profile.histogram(df, "v", bins, clip).collect()}
    assert {b: r["count"] for b, r in got.items()} == {
        b: c for b, c in enumerate(counts) if c
    }
    assert all(r.bin_start == pytest.approx(edges[b]) for b, r in got.items())


def test_histogram_of_one_value(spark):
    df = spark.range(3).select(F.lit(7).alias("v"))
    assert [(r.bin, r["count"]) for r in profile.histogram(df, "v", 10).collect()] == [(5, 3)]


def test_rank_percentiles(numbers):
    values, df = numbers
    points = {"p0": 0.0, "p50": 0.5, "p95": 0.95}
    r = profile.rank_percentiles(df, "v", points).first()
    ordered = sorted(values)
    for name, p in points.items():
        assert r[name] == ordered[int(len(values) * p)]
    assert (r.n_rows, r["min"], r["max"]) == (len(values), ordered[0], ordered[-1])


def test_outliers_presence_coverage(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", None), ("b", 2000), (None, 3)], "k string, v int"
    )
    assert tuple(profile.count_outliers(df, "v").first()) == (2, 1)
    assert tuple(profile.presence(df, F.col("v").isNotNull()).first()) == (3, 1, 75.0)
    rows = [tuple(r) for r in profile.coverage_by(df, "k", F.col("v").isNotNull()).collect()]
    assert rows == [("a", 1, 2, 50.0), ("b", 1, 1, 100.0)]


def test_top_values(spark):
    df = spark.range(100).select((F.col("id") % 30).alias("product"), F.lit("x").alias("z"))
    out = profile.top_values(df, ["product", "category"], 20).collect()
    assert len(out) == 20 and {r["column"] for r in out} == {"product"}
    assert {r["value"] for r in out if r["count"] == 4} == {str(i) for i in range(10)}
    assert profile.top_values(df, ["missing"]).count() == 0
