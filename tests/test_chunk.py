import random

import chunk_model
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plaintlens.functions.chunk import split_text
from plaintlens.operators import chunking

SETTINGS = [(50, 5), (30, 10), (20, 0), (12, 12)]


def some_texts(n, seed):
    rng = random.Random(seed)
    out = ["", " ", "a", "a" * 50, "a" * 51, "\n\n\n\n", "word " * 200, " ".join(["x" * 49] * 5)]
    for _ in range(n):
        longer = rng.choice([0, 0.02, 0.3])
        parts = []
        for _ in range(rng.randint(0, 80)):
            size = rng.randint(20, 90) if rng.random() < longer else rng.randint(1, 9)
            parts.append("".join(rng.choice("abéß") for _ in range(size)))
            parts.append(rng.choice([" ", " ", " ", "  ", ". ", "\n", "\n\n", "\n\n\n", ".", "\t"]))
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("size, overlap", SETTINGS)
def test_against_plain_statement_of_the_rule(apply, size, overlap):
    texts = some_texts(120, size)
    got = apply(lambda c: split_text(c, size, overlap), texts)
    assert got == [chunk_model.split(t, size, overlap) for t in texts]


@given(st.lists(st.text(alphabet="ab .\n", max_size=60), min_size=1, max_size=20))
@settings(max_examples=8, deadline=None)
def test_any_text(apply, texts):
    got = apply(lambda c: split_text(c, 10, 3), texts)
    assert got == [chunk_model.split(t, 10, 3) for t in texts]
    assert all(len(c) <= 10 for chunks in got for c in chunks)


def test_rejects_impossible_settings():
    with pytest.raises(ValueError):
        split_text(None, 10, 11)


@pytest.fixture(scope="module")
def complaints(spark):
    rows = [(1, "Credit Card", "word " * 200), (2, "Personal Loan", "short text"),
            (3, "Credit Card", ""), (4, "Credit Card", None)]
    return spark.createDataFrame(
        rows, "complaint_id long, product_category string, cleaned_narrative string"
    )


def test_chunk_table(complaints):
    rows = chunking.chunk_table(complaints, size=100, overlap=10, cleaned=False).collect()
    assert {r.complaint_id for r in rows} == {"1", "2"}
    long = sorted((r for r in rows if r.complaint_id == "1"), key=lambda r: r.chunk_index)
    assert [r.chunk_index for r in long] == list(range(len(long)))
    assert all(r.total_chunks == len(long) and len(r.chunk_text) <= 100 for r in long)
    [short] = [r for r in rows if r.complaint_id == "2"]
    assert (short.chunk_index, short.total_chunks, short.chunk_text) == (0, 1, "short text")


def test_empty_table(complaints):
    out = chunking.chunk_table(complaints.filter("false"))
    assert out.count() == 0
    assert out.columns == [
        "complaint_id", "product_category", "chunk_index", "total_chunks", "chunk_text",
    ]


def test_extra_columns_are_kept(complaints):
    out = chunking.chunk_table(complaints.withColumn("state", F.lit("NY")), keep=["state"])
    assert set(out.columns) >= {"state"} and out.filter("state = 'NY'").count() == out.count()


def test_sweep_counts_unsplit_complaints_too(complaints):
    row = chunking.chunk_sweep(complaints, [(100, 10)]).first()
    chunks = chunking.chunk_table(complaints, size=100, overlap=10).count()
    assert row.total_chunks == chunks
    assert row.avg_chunks_per_complaint == round(chunks / 4, 2)


def test_first_multichunk(complaints):
    chunks = chunking.chunk_table(complaints, size=100, overlap=10)
    shown = chunking.first_multichunk(chunks)
    assert {r.complaint_id for r in shown.collect()} == {"1"}
    assert chunking.first_multichunk(chunks.filter("total_chunks = 1")).count() == 0
