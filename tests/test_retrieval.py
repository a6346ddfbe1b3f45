import numpy as np
import pytest
from pyspark.sql import functions as F

from plaintlens import constants as C
from plaintlens.operators import chunking, retrieval
from plaintlens.operators.embedding import embed_with, hash_embed, pca_2d
from plaintlens.plans import jobs

QUESTION = "question_id string, question string, filter_category string"


def reasons(spark, rows):
    df = retrieval.check_questions(spark.createDataFrame(rows, QUESTION))
    return {r.question_id: (r.question, r.reject_reason) for r in df.collect()}


def test_question_checks(spark):
    got = reasons(
        spark,
        [
            ("none", None, None),
            ("empty", "", None),
            ("blank", " \n　", None),
            ("long", "x" * 5000, None),
            ("edge", "  " + "x" * 1000 + "  ", None),
            ("padded", "  why? ", ""),
            ("category", "why?", "Mortgage"),
            ("fine", "why?", "Credit Card"),
        ],
    )
    assert got["none"][1] == "Question must be text."
    assert got["empty"][1] == got["blank"][1]
    assert got["blank"][1] == "Question cannot be empty. Please type a question."
    assert "(5000 characters)" in got["long"][1] and "1000" in got["long"][1]
    assert got["edge"][1] is None
    assert got["padded"] == ("why?", None)
    assert got["category"][1] == (
        "Invalid product_category 'Mortgage'. Must be one of: "
        "['Credit Card', 'Money Transfer', 'Personal Loan', 'Savings Account']"
    )
    assert got["fine"] == ("why?", None)


def test_strict_mode_fails_the_job(spark):
    df = spark.createDataFrame([("a", "", None)], QUESTION)
    with pytest.raises(Exception, match="cannot be empty"):
        retrieval.check_questions(df, strict=True).collect()


@pytest.fixture(scope="module")
def store(spark):
    rows = [
        (1, "Credit Card", "late fee charge card"),
        (2, "Credit Card", "fraud charge stolen card"),
        (3, "Personal Loan", "loan payment interest high"),
        (4, "Money Transfer", "transfer money lost delay"),
    ]
    df = spark.createDataFrame(
        rows, "complaint_id long, product_category string, cleaned_narrative string"
    )
    return jobs.to_store(chunking.chunk_table(df)).cache()


def test_retrieve_ranks_and_fills(spark, store):
    asked = spark.createDataFrame(
        [("a", "stolen card fraud", None), ("b", "card charge", "Personal Loan"), ("c", "", None)],
        QUESTION,
    )
    hits = retrieval.retrieve(asked, store, 2).orderBy("question_id", "rank").collect()
    assert [(h.question_id, h.rank, h.id) for h in hits] == [
        ("a", 1, "2_0"), ("a", 2, "1_0"), ("b", 1, "3_0"),
    ]
    top = hits[0]
    assert (top.complaint_id, top.chunk_index, top.total_chunks) == ("2", 0, 1)
    assert (top.company, top.issue, top.sub_issue, top.date_received) == ("", "", "", "")
    # three of four words in common: cosine 3 / (sqrt 3 * sqrt 4)
    assert top.cosine == pytest.approx(3 / 12**0.5, abs=1e-4)
    assert top.similarity_score == pytest.approx(2 * 3 / 12**0.5 - 1, abs=1e-4)


def test_rich_metadata_passes_through(spark):
    found = spark.createDataFrame([("q", "x_0", 0.2, 1)], "question_id string, id string, distance double, rank int")
    rich = spark.createDataFrame(
        [("x_0", "text", [0.0], "9", "Credit Card", 2, 3, "ACME", "Fees", "Late", "2024-01-01")],
        "id string, document string, embedding array<float>, complaint_id string, product_category string, "
        "chunk_index int, total_chunks int, company string, issue string, sub_issue string, date_received string",
    )
    h = retrieval.attach_metadata(found, rich).first()
    assert (h.company, h.issue, h.sub_issue, h.date_received) == ("ACME", "Fees", "Late", "2024-01-01")
    assert (h.chunk_index, h.total_chunks, h.similarity_score) == (2, 3, 0.8)


def test_sparse_fields_get_defaults(spark):
    sparse = spark.createDataFrame([("x",)], "id string")
    r = retrieval.fill_hit_fields(sparse).first()
    assert (r.complaint_id, r.chunk_index, r.total_chunks, r.company) == ("", 0, 1, "")


def test_union_of_stores(spark, store):
    rich = store.limit(1).withColumn("company", F.lit("ACME")).withColumn("id", F.lit("r_0"))
    both = retrieval.union_stores(store, rich)
    assert both.count() == 5
    assert {r.company for r in both.collect()} == {"ACME", ""}


def test_hash_embedding_is_unit_length_and_repeatable(spark, apply):
    df = spark.createDataFrame([(1, "a b b"), (2, ""), (3, None)], "i int, chunk_text string")
    rows = {r.i: np.array(r.embedding) for r in hash_embed(df, dim=32).collect()}
    assert len(rows[1]) == 32 and np.linalg.norm(rows[1]) == pytest.approx(1, abs=1e-6)
    assert sorted(rows[1][rows[1] > 0]) == pytest.approx([1 / 5**0.5, 2 / 5**0.5], abs=1e-6)
    assert not rows[2].any() and not rows[3].any()
    assert hash_embed(df.filter("false")).count() == 0


def test_user_model_gets_batches_and_is_made_per_task(spark):
    def make():
        def encode(texts):
            assert 0 < len(texts) <= 3
            return [[len(t), 0.0] for t in texts]

        return encode

    df = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(10)], "i int, t string")
    raw = embed_with(df.coalesce(1), make, "t", batch_size=3, normalize=False)
    assert {r.i: r.embedding[0] for r in raw.collect()} == {i: i + 1 for i in range(10)}
    unit = embed_with(df, make, "t", batch_size=3)
    assert {tuple(r.embedding) for r in unit.collect()} == {(1.0, 0.0)}
    assert embed_with(df.filter("false"), make, "t").count() == 0


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(60, 5)) * [5, 3, 1, 1, 1] + 10
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "i int, embedding array<double>")
    rows, shares = pca_2d(df)
    got = np.array([[r.pc1, r.pc2] for r in rows.orderBy("i").collect()])
    centred = m - m.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(centred @ vt[:2].T), abs=1e-8)
    assert shares == pytest.approx((s**2 / (s**2).sum())[:2].tolist())


def test_quality_measures(spark):
    hits = spark.createDataFrame(
        [("a", "Credit Card", 0.9), ("a", "Personal Loan", 0.1), ("b", "Personal Loan", -0.3)],
        "question_id string, product_category string, similarity_score double",
    )
    questions = spark.createDataFrame([("a", "Credit Card"), ("b", "Personal Loan")], "question_id string, category string")
    assert tuple(retrieval.retrieval_quality(hits, questions).first()) == (3, 0.3333, 2)
    answers = spark.createDataFrame(
        [(C.NOT_ENOUGH_INFORMATION + " to answer that.",), ("yes",), (None,)], "answer string"
    )
    assert tuple(retrieval.unanswered_rate(answers).first()) == (3, 0.3333)
