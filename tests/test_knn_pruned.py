import numpy as np
import pytest

from plaintlens.operators import knn
from plaintlens.operators.knn_pruned import clusters_read, knn_pruned
from tests.test_knn import brute as plain_brute
from tests.test_knn import found

DIM, K = 8, 4


def brute(questions, store, k):
    """Vectors are compared with those of their own length only."""
    out = {}
    for qid, v in questions:
        out.update(plain_brute([(qid, v)], [r for r in store if len(r[1]) == len(v)], k))
    return out


@pytest.fixture(scope="module")
def clumps(spark):
    """Twelve far-apart clumps; one vector repeated over a third of the store; two lengths."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, DIM)) * 20
    vectors = [(centres[i % 12] + rng.normal(size=DIM)).tolist() for i in range(600)]
    vectors[200:400] = [vectors[200]] * 200
    store = [(f"s{i:03d}", v, f"c{i % 3}") for i, v in enumerate(vectors)]
    store += [("short1", [1.0, 2.0], "c0"), ("short2", [1.0, 2.5], "c1")]
    questions = [(f"q{i}", (centres[i % 12] + rng.normal(size=DIM)).tolist()) for i in range(24)]
    questions += [("copy", vectors[200]), ("short", [1.0, 2.1])]
    q = spark.createDataFrame(questions, "question_id string, embedding array<double>")
    s = spark.createDataFrame(store, "id string, embedding array<double>, product_category string")
    return questions, store, q, s.repartition(5)


@pytest.mark.parametrize("max_bytes", [knn.MAX_QUESTION_BYTES, 500])
def test_equals_brute_force_and_prunes(clumps, max_bytes):
    questions, store, q, s = clumps
    got = found(knn_pruned(q, s, K, centres=16, max_question_bytes=max_bytes))
    assert got == brute(questions, store, K)
    assert [i for i, _ in got["copy"]] == ["s200", "s201", "s202", "s203"]
    assert got["short"] == brute([("short", [1.0, 2.1])], store, 2)["short"]
    read = clusters_read()
    if max_bytes == 500:  # blocks of a few questions need a few clumps each
        assert len(read) > 1 and sum(a + b for a, b, _ in read) < sum(n for _, _, n in read)


def test_same_rows_as_plain_search_with_categories(clumps, spark):
    _, _, q, s = clumps
    asked = q.selectExpr("question_id", "embedding", "CASE WHEN question_id < 'q2' THEN 'c1' END AS filter_category")
    plain = sorted(tuple(r) for r in knn.nearest(asked, s, K).collect())
    pruned = sorted(tuple(r) for r in knn_pruned(asked, s, K, centres=16).collect())
    assert pruned == plain


def test_empty_store_and_no_questions(clumps, spark):
    _, _, q, s = clumps
    assert knn_pruned(q, s.limit(0), K).collect() == []
    assert knn_pruned(q.limit(0), s, K).collect() == []
