import numpy as np
import pytest
from pyspark.sql import functions as F

from plaintlens.operators import knn

DIM, K = 12, 4


def brute(questions, store, k, filters=None):
    out = {}
    for qid, q in questions:
        wanted = (filters or {}).get(qid, "")
        found = sorted(
            (round(float(((np.asarray(q) - np.asarray(v)) ** 2).sum()), 9), sid)
            for sid, v, cat in store
            if not wanted or cat == wanted
        )
        out[qid] = [(i, d) for d, i in found[:k]]
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)

    def units(n):
        m = rng.normal(size=(n, DIM)).astype("float32")
        return (m / np.linalg.norm(m, axis=1, keepdims=True)).tolist()

    vectors = units(400)
    vectors[100:240] = [vectors[100]] * 140  # a third of the store is one vector
    store = [(f"s{i}", v, f"c{i % 3}") for i, v in enumerate(vectors)]
    questions = [(f"q{i}", v) for i, v in enumerate(units(30))] + [("copy", vectors[100])]
    return (
        questions,
        store,
        spark.createDataFrame(questions, "question_id string, embedding array<float>"),
        spark.createDataFrame(
            store, "id string, embedding array<float>, product_category string"
        ).repartition(6),
    )


def found(df):
    out = {}
    for r in df.orderBy("question_id", "rank").collect():
        out.setdefault(r.question_id, []).append((r.id, pytest.approx(r.distance, abs=2e-9)))
    return out


@pytest.mark.parametrize("max_bytes", [knn.MAX_QUESTION_BYTES, 1_000])
def test_equals_brute_force(data, max_bytes):
    """Both ways, with ties that go to the smaller id; blocks are small enough to be several."""
    questions, store, q, s = data
    got = found(knn.nearest(q, s, K, max_question_bytes=max_bytes))
    assert got == brute(questions, store, K)
    assert [i for i, _ in got["copy"]] == ["s100", "s101", "s102", "s103"]


@pytest.mark.parametrize("max_bytes", [knn.MAX_QUESTION_BYTES, 1_000])
def test_category_filter(data, max_bytes):
    questions, store, q, s = data
    filters = {qid: f"c{i % 4}" for i, (qid, _) in enumerate(questions)}  # c3 holds nothing
    mapping = F.create_map(*[F.lit(x) for pair in filters.items() for x in pair])
    filtered = q.withColumn("filter_category", mapping[F.col("question_id")])
    got = found(knn.nearest(filtered, s, K, max_question_bytes=max_bytes))
    want = {k: v for k, v in brute(questions, store, K, filters).items() if v}
    assert got == want


def test_empty_filter_means_all(data):
    questions, store, q, s = data
    q = q.withColumn("filter_category", F.when(F.col("question_id") == "q1", "").otherwise("c1"))
    filters = {qid: "c1" for qid, _ in questions if qid != "q1"}
    assert found(knn.nearest(q, s, K)) == brute(questions, store, K, filters)


def test_small_store_gives_fewer(data, spark):
    _, _, q, s = data
    small = s.filter("id in ('s1', 's2')")
    assert knn.nearest(q, small, K).groupBy("question_id").count().filter("count <> 2").count() == 0
    assert knn.nearest(q, s.filter("false"), K).count() == 0
    assert knn.nearest(q.filter("false"), s, K).count() == 0


def test_other_dimensions_never_match(data, spark):
    _, _, q, s = data
    odd = spark.createDataFrame(
        [("odd", [1.0], "c1")], "id string, embedding array<float>, product_category string"
    )
    assert knn.nearest(q, s.union(odd), K).filter("id = 'odd'").count() == 0


def test_each_length_is_searched_on_its_own(data, spark):
    questions, store, q, s = data
    schema = "id string, embedding array<float>, product_category string"
    mixed = s.union(spark.createDataFrame([("one", [1.0], "c1"), ("two", [1.0, 2.0], "c1")], schema))
    asked = q.union(spark.createDataFrame([("short", [1.0]), ("odd", [1.0] * 3)], q.schema))
    got = found(knn.nearest(asked, mixed, K))
    assert got == {**brute(questions, store, K), "short": [("one", 0.0)]}
    refused = knn.incomparable(asked, mixed).collect()
    assert [r.question_id for r in refused] == ["odd"] and "has 3 numbers" in refused[0].reject_reason
    assert knn.incomparable(asked, mixed.filter("false")).count() == 0


def test_no_block_shuffles_the_store(data):
    _, _, q, s = data
    plan = knn.nearest(q, s, K)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning(question_id") == 1


def test_many_questions_never_reach_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(str(i), rng.normal(size=4 if i % 3 else 6).tolist(), f"c{i % 2}") for i in range(300)] + [("999", None, "c0")]
    store = spark.createDataFrame(rows, "id string, embedding array<double>, product_category string").repartition(3)
    asked = store.where("embedding IS NOT NULL").selectExpr(
        "IF(id = '5', null, id) AS question_id", "embedding", "IF(id % 5 = 0, 'c1', '') AS filter_category"
    )
    want = sorted(map(tuple, knn.nearest(asked, store, 3).collect()), key=repr)
    collected = []
    collect = type(store).collect

    def counted(df):
        rows = collect(df)
        collected.extend(rows)
        return rows

    monkeypatch.setattr(type(store), "collect", counted)
    for bound in (10_000, 100):
        found = knn.nearest(asked, store, 3, max_question_bytes=bound)
        assert not [r for r in collected if "embedding" in r]
        assert sorted(map(tuple, collect(found)), key=repr) == want
