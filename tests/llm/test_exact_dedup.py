import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plaintlens.llm.exact_dedup import chunk_list, exact_dedup, kept_documents

LONG = "The cat sat. " * 3000 + "x" * 20000
ROWS = [
    (1, "a"), (2, "a"), (3, None), (4, ""), (5, LONG), (6, LONG), (7, LONG + "y"), (8, "a "),
    (9, "Ünï çödé 𝄞 " * 900), (10, "Ünï çödé 𝄞 " * 900), (None, "solo"), (11, "a"), (11, "a"),
    (None, "b"), (12, "b"),
]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    keep = {t: max([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    out, seen = [], set()
    for i, t in rows:
        t = t or ""
        kept = i == keep[t] and (i, t) not in seen
        seen.add((i, t))
        out.append((i, keep[t], len(groups[t]), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, hash string")


@pytest.mark.parametrize("bad_hash", [False, True])
def test_against_brute_force(spark, bad_hash):
    hashed = {"chunk_hash": lambda c: F.length(c) % 3} if bad_hash else {}
    got = exact_dedup(table(spark, ROWS), **hashed)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)


def test_chunks_join_to_the_text(apply):
    for text in (LONG, "", "a\nb", "é" * 9000):
        (chunks,) = apply(chunk_list, [text])
        assert "".join(chunks) == text


def test_empty_table(spark):
    assert exact_dedup(table(spark, [])).collect() == []


def test_kept_documents(spark):
    rows = kept_documents(table(spark, ROWS)).collect()
    ids = sorted((r.doc_id for r in rows), key=str)
    assert ids == sorted([11, 4, 6, 7, 8, 10, 12, None], key=str)
    assert rows[0].asDict().keys() == {"doc_id", "text", "hash"}


def test_no_python_in_the_plan(spark):
    plan = exact_dedup(table(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
