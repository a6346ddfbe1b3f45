import hashlib
import random

import numpy as np
import pytest

from plaintlens.llm.suffix_dedup import (
    Sizes, Splitters, as_tokens, common_bytes, multikey_order, kept_documents, repeated_windows, suffix_dedup)


def brute(rows):
    """rows: (doc_id, text) in the order of documents."""
    seen, out = set(), []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - 99):
            window = raw[i : i + 100]
            if window in seen:
                gone[i : i + 100] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if raw else 0
        out.append((doc_id, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [prose(k) for k in (12, 20, 40, 90)]
    texts = []
    for _ in range(n):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 3)
            parts += [p[cut : len(p) - rng.randint(0, len(p) // 3)], prose(rng.randint(0, 30))]
        texts.append(rng.choice([" ", "\n"]).join(parts))
    return texts + rng.choices(texts, k=8)


def table(spark, rows):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, key int")


EDGE = [
    None, "", "x" * 99, "x" * 100, "x" * 101, "x" * 100, "ab" * 300, "\0" * 150, "\0" * 40 + "q" * 80,
    "é" * 130, "abcdefghij" * 40, "y" * 30 + "z" * 69, "y" * 30 + "z" * 70,
]
SMALL = Sizes(slice=700, records=150, bucket_bytes=400, sample=2_000)


@pytest.mark.parametrize("sizes", [Sizes(), SMALL])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, sizes, seed):
    texts = corpus(seed) + EDGE
    rng = random.Random(seed)
    ids = rng.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts))
    df = table(spark, rows).repartition(5)
    got = sorted(map(tuple, suffix_dedup(df, sizes=sizes).collect()))
    want = brute(sorted(rows, key=lambda r: r[0]))
    assert got == want
    assert sum(r[2] for r in want) > 5_000


def test_a_hot_passage_is_split_and_compared_across_buckets(spark):
    rng = random.Random(5)
    noise = lambda k: "".join(rng.choice("abcdefghijklmnop ") for _ in range(k))
    hot = noise(60)  # too short to repeat alone, but with one byte more on either side it may
    rows = [(i, noise(80) + rng.choice(["k" * 50, noise(50)]) + hot + rng.choice(["v" * 45, noise(45)])) for i in range(150)]
    sizes = Sizes(slice=2_000, records=100, bucket_bytes=600, sample=100_000)
    got = sorted(map(tuple, suffix_dedup(table(spark, rows).repartition(4), sizes=sizes).collect()))
    assert got == brute(rows)


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted(map(tuple, suffix_dedup(table(spark, rows)).collect()))
    assert got == brute(sorted(rows))


def test_shared_and_missing_ids(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = [(None, long), (None, long[:200]), (1, long), (1, "A" + long), (2, long[50:])]
    got = sorted(map(tuple, suffix_dedup(table(spark, rows)).collect()), key=str)
    want = brute(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])))
    assert got == sorted(want, key=str)


def test_kept_text_and_empty_table(spark):
    rng = random.Random(3)
    long = "é" * 3 + "".join(rng.choice("abcdefgh ") for _ in range(400))
    df = table(spark, [(1, long), (2, "head " + long + " tail"), (3, None), (4, long)])
    df = df.selectExpr("doc_id", "text", "key AS kept", "cast(-1 AS bigint) AS n_chars")
    rows = sorted(map(tuple, kept_documents(df).collect()))
    assert rows == [(1, long, 0, 403), (2, "head  tail", 0, 10), (3, "", 0, 0)]
    assert suffix_dedup(table(spark, [])).collect() == []


def test_multikey_order():
    rng = random.Random(1)
    rows = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    tokens = as_tokens(rows, 40)
    order, same = multikey_order(tokens)
    padded = [r.ljust(40, b"\0") for r in rows]
    assert [padded[i] for i in order] == sorted(padded)
    common = common_bytes(tokens, order, same)
    for i in range(1, 500):
        a, b = padded[order[i - 1]], padded[order[i]]
        assert common[i] == next((j for j in range(40) if a[j] != b[j]), 40)


def test_splitters_spread_a_hot_core():
    cores = [b"%032d" % i for i in range(50)] + [b"hot".ljust(32)] * 50
    s = Splitters(cores, 10)
    hot = {s.bucket(b"hot".ljust(32), k, 0) for k in range(100)}
    assert len(hot) > 1 and all(spread for _, spread in hot)
    assert not s.bucket(cores[3], 1, 1)[1] and Splitters([], 5).bucket(b"x", 1, 1) == (0, False)


def test_no_repeats():
    row, distance = repeated_windows(np.array([3]), np.array([1]), [b"x" * 102])
    assert len(row) == len(distance) == 0
