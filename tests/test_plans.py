"""The shapes of the plans that decide whether the work scales."""
import re

from conftest import SMALL
from pyspark.sql import functions as F

from plaintlens.operators import sampling
from plaintlens.plans import queries as Q


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_and_chunking_stay_in_the_jvm_and_run_once(spark):
    plan = plan_of(Q.chunk_rows(spark, SMALL))
    assert "Python" not in plan and "MapInArrow" not in plan
    assert plan.count("aggregate(sequence") == 1
    assert plan.count("array_join(transform(") == 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # no shuffle but the one that spreads a scan of fewer splits than cores
    assert plan.count("Exchange hashpartitioning") == 0


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(Q.mapped_complaints(spark, SMALL))
    assert "PushedFilters: [IsNotNull(text), IsNotNull(source)]" in plan
    plan = plan_of(Q.product_counts(spark, SMALL))
    assert "ReadSchema: struct<source:string>" in plan


def test_category_cap_is_trimmed_before_the_shuffle(spark):
    plan = plan_of(Q.category_cap(spark, SMALL))
    assert plan.count("WindowGroupLimit") == 2


def test_knn_reads_no_text_and_trims_ranks(spark):
    plan = plan_of(Q.knn_topk(spark, SMALL))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan and "MapInArrow" in plan


def test_category_questions_prune_store_partitions(spark):
    import tempfile

    from plaintlens.operators import knn
    from plaintlens.sources import readers, writers

    base = tempfile.mkdtemp(prefix="plaintlens-test-")
    writers.write_collection(Q.vector_store(spark, SMALL), base, "v")
    asked = Q.category_questions(spark, SMALL).filter("question_id = 'label 3'")
    asked = asked.withColumn("filter_category", F.col("question_id"))
    plan = plan_of(knn.nearest(asked, readers.open_collection(spark, base, "v"), 3))
    assert re.search(r"PartitionFilters: \[[^\]]*product_category[^\]]*label 3", plan)


def test_taking_a_sample_shuffles_nothing(spark):
    df = spark.range(1000).select(
        F.col("id").alias("complaint_id"), (F.col("id") % 2).alias("product_category")
    )
    plan = plan_of(sampling.stratified_sample(df, 100))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "Window" not in plan
