import pytest
from pyspark.sql import functions as F

from plaintlens.operators import sampling
from plaintlens.operators.profile import align_shares


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(600).select(
        F.col("id").alias("complaint_id"),
        F.when(F.col("id") < 500, "Credit Card").otherwise("Personal Loan").alias("product_category"),
    )


def ids(df):
    return {r.complaint_id for r in df.collect()}


def test_exact_group_sizes(table):
    counts = dict(
        sampling.stratified_sample(table, 120).groupBy("product_category").count().collect()
    )
    assert counts == {"Credit Card": 100, "Personal Loan": 20}


def test_takes_the_lowest_draw_keys(table):
    key = sampling.draw_order("complaint_id", 42)
    want = set()
    for name, n in [("Credit Card", 100), ("Personal Loan", 20)]:
        group = table.filter(F.col("product_category") == name)
        want |= ids(group.orderBy(key, "complaint_id").limit(n))
    assert ids(sampling.stratified_sample(table, 120)) == want


def test_seed_decides(table):
    first = ids(sampling.stratified_sample(table, 120))
    assert first == ids(sampling.stratified_sample(table.repartition(3), 120))
    assert first != ids(sampling.stratified_sample(table, 120, seed=7))


def test_more_than_all_returns_all(spark, table):
    rows = table.union(spark.sql("SELECT 9999L, CAST(NULL AS STRING)"))
    assert sampling.stratified_sample(rows, 10_000).count() == 601


def test_null_category_drops_but_counts(spark, table):
    nulls = spark.range(1000, 1600).select(
        F.col("id").alias("complaint_id"), F.lit(None).cast("string").alias("product_category")
    )
    out = sampling.stratified_sample(table.union(nulls), 120)
    counts = dict(out.groupBy("product_category").count().collect())
    assert counts == {"Credit Card": 50, "Personal Loan": 10}


def test_halves_round_to_even_and_minimum_applies(spark):
    df = spark.range(40).select(
        F.col("id").alias("complaint_id"),
        F.when(F.col("id") < 5, "a").when(F.col("id") < 6, "b").otherwise("c").alias("product_category"),
    )
    counts = dict(sampling.stratified_sample(df, 20).groupBy("product_category").count().collect())
    assert counts == {"a": 2, "c": 17}  # 2.5 -> 2, 0.5 -> 0
    counts = dict(
        sampling.stratified_sample(df, 20, min_per_group=1).groupBy("product_category").count().collect()
    )
    assert counts == {"a": 2, "b": 1, "c": 17}


def test_minimum_above_a_group_takes_all_of_it(table):
    out = sampling.stratified_sample(table, 120, min_per_group=300)
    counts = dict(out.groupBy("product_category").count().collect())
    assert counts == {"Credit Card": 300, "Personal Loan": 100}


def test_repeated_ids_keep_sizes_exact(spark):
    df = spark.range(600).select(
        F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("complaint_id"),
        F.lit("a").alias("product_category"),
    )
    for n in (50, 300, 500):
        assert sampling.stratified_sample(df, n).count() == n


def test_cap(table):
    out = sampling.cap_per_category(table, 30, id_column="complaint_id")
    counts = dict(out.groupBy("product_category").count().collect())
    assert counts == {"Credit Card": 30, "Personal Loan": 30}


def test_summary_and_alignment(table):
    rows = [tuple(r) for r in sampling.sample_summary(table).collect()]
    assert rows == [("Credit Card", 500, 83.3), ("Personal Loan", 100, 16.7)]
    other = table.filter("product_category = 'Credit Card'")
    both = {r[0]: r[1:] for r in align_shares(table, other, "product_category", "l", "r").collect()}
    assert both == {"Credit Card": (83.3, 100.0), "Personal Loan": (16.7, None)}
