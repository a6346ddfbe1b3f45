"""Importance resampling against a plain Python version of the contract."""

import hashlib
import math
import re
import zlib

from plaintlens.llm.resampling import features, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, target):
    bucket = lambda w: zlib.crc32(w.encode()) % 10000
    s, t = [0] * 10000, [0] * 10000
    for _, text in docs:
        for w in words(text):
            s[bucket(w)] += 1
    for text in target:
        for w in words(text):
            t[bucket(w)] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log(((t[b] + 1) * float(S + 10000)) / ((s[b] + 1) * float(T + 10000)))) for b in range(10000)]
    rows = []
    for i, (doc_id, text) in enumerate(docs):
        ws = words(text)
        weight = sum(gain[bucket(w)] for w in ws) // len(ws) if ws else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(ws), weight, score, None, i])
    eligible = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    for rank, r in enumerate(eligible[: len(eligible) * 10 // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def run(spark, docs, target):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS row", "1 AS score", "2 AS weight")
    b = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    return sorted((tuple(r) for r in resample(d, b).collect()), key=repr)


def test_features_stay_in_their_document():
    buckets, owners, n_words = features(["Ab cd", None, "", "x\x00y", "é ü-ß"])
    assert n_words.tolist() == [2, 0, 0, 2, 3]
    assert owners.tolist() == [0, 0, 3, 3, 4, 4, 4]
    assert buckets[0] == zlib.crc32(b"ab") % 10000


def test_against_brute_force(spark):
    vocab = [f"w{i}" for i in range(60)] + ["Alpha", "beta", "Gamma", "ñu"]
    docs = []
    for i in range(120):
        n = 5 + (i * 7) % 40
        docs.append((i, " ".join(vocab[(i * j + j) % len(vocab)] for j in range(n))))
    docs += [(500, None), (501, ""), (502, "!!! ???"), (3, docs[3][1]), (3, docs[3][1]), (None, docs[10][1])]
    target = ["alpha beta gamma ñu " * 5, "w1 w2 w3", None]
    assert run(spark, docs, target) == brute(docs, target)


def test_empty_tables(spark):
    assert run(spark, [], ["alpha beta"]) == []
    docs = [(1, "a b c " * 10), (2, None)]
    assert run(spark, docs, []) == brute(docs, [])
