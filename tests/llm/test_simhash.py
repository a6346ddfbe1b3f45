import random
import re

import numpy as np
import pytest
import xxhash

from plaintlens.llm import simhash
from plaintlens.llm.components import connected_components
from plaintlens.llm.simhash import allocation, fingerprints_of, forest, links, masks_of, simhash_components


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    rows = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=3):
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if label[i] != label[j] and (prints[i] ^ prints[j]).bit_count() <= distance:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def prose(rng, n):
    return " ".join(rng.choice(("Alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta")) for _ in range(n))


def family(rng, n, size):
    words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        own = list(words)
        own[rng.randrange(size)] = "edit"
        out.append(" ".join(own))
    return out


def table(spark, texts):
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, fp int")


@pytest.mark.parametrize("bucket", [1_000, 3])
def test_against_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(3)
    texts = [None, "", " \n", "one", "One", "one two", "a b c", "É é", prose(rng, 20_000)]
    texts += [prose(rng, rng.randint(1, 60)) for _ in range(60)] + family(rng, 25, 300) + family(rng, 25, 900)
    texts += texts[-3:]
    prints = [brute_print(t) for t in texts]
    want = brute_components(prints)
    got = sorted(map(tuple, simhash_components(table(spark, texts)).collect()))
    assert got == [(i, f"{p:016x}", c) for i, (p, c) in enumerate(zip(prints, want))]
    assert len(set(want)) < len(want) - 10


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    prints = [brute_print(r.text) for r in rows]
    assert fingerprints_of([r.text for r in rows], 3).tolist() == prints
    df = spark.createDataFrame(rows)
    want = brute_components(prints)
    got = {r.doc_id: r.component_id for r in simhash_components(df).collect()}
    assert got == {rows[i].doc_id: rows[c].doc_id for i, c in enumerate(want)}


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d", 0), (None, "a b c d", 0), (5, "x y z", 0), (None, "x y z", 0)]
    got = simhash_components(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [
        ("5", "5"), ("None", "5"), ("None", "None"), ("None", "None")]
    assert simhash_components(table(spark, [])).collect() == []


@pytest.mark.parametrize("rows", [100, 10**6, 10**11])
def test_every_near_pair_shares_a_bucket(rows):
    rng = np.random.default_rng(1)
    bits = (rng.random((500, 64)) < rng.random(64)).astype(float)
    parts, thresholds = allocation(rows, (bits.T @ bits * rows / 500).astype(int), 3)
    assert sorted(sum(parts, [])) == list(range(64))
    assert sum(thresholds) == 3 - len(parts) + 1
    masks = masks_of(parts, thresholds)
    for _ in range(500):
        flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(int(m) & flips == 0 for m in masks)


def test_forest_has_one_link_a_row_at_most():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 2**6, 200).astype(np.uint64)
    a, b = forest(np.zeros(200, int), np.zeros(200, int), fp, 3)
    assert len(a) < 200 and (np.bitwise_count(a ^ b) <= 64).all()


def test_links_connect_a_chain(spark):
    chain = [0]
    for i in range(40):
        chain.append(chain[-1] ^ (1 << i))
    df = spark.createDataFrame([(x,) for x in chain], "fp long")
    roots = {r.node: r.root for r in connected_components(links(df, 3)).collect()}
    assert set(roots.values()) == {0} and len(roots) == 40
