"""The near-duplicate stage against brute force: five-word shingles, Jaccard 0.8 or more."""

import random
import re
from collections import defaultdict

from test_simhash import family, prose

from plaintlens.llm.stages import near_stage

SCHEMA = "doc_id long, text string, lang string"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_pairs(texts):
    """(i, j) with Jaccard similarity of 0.8 or more."""
    sets, held = [shingle_set(t) for t in texts], defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            held[x].append(i)
    pairs = {(a, b) for ids in held.values() for k, b in enumerate(ids) for a in ids[:k]}
    return {(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}


def smallest_kept(texts, pairs):
    label = list(range(len(texts)))
    empty = [i for i, t in enumerate(texts) if not shingle_set(t)]
    pairs = sorted(pairs) + [(empty[0], i) for i in empty[1:]]
    while any(label[a] != label[b] for a, b in pairs):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return sorted(set(label))


def kept(spark, rows):
    return sorted(r.doc_id for r in near_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect())


def test_made_up_texts(spark):
    rng = random.Random(5)
    texts = [None, "", "one", "One", "one two", "a b c d e f", prose(rng, 20_000)]
    texts += family(rng, 6, 150) + family(rng, 6, 600) + [prose(rng, rng.randint(1, 60)) for _ in range(20)]
    words = [f"w{i}" for i in range(300)]
    # close in bits, but one place in eight changed: similarity far below the bar
    texts += [" ".join(words), " ".join("x" if i % 8 == 0 else w for i, w in enumerate(words))]
    texts += [" ".join(words[:290])]
    assert kept(spark, [(i, t, "en") for i, t in enumerate(texts)]) == smallest_kept(texts, near_pairs(texts))


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    last = {r.text or "": r.doc_id for r in sorted(rows)}  # as after exact dedup
    ids = sorted(last.values())
    by_id = {r.doc_id: r.text for r in rows}
    texts = [by_id[i] for i in ids]
    pairs = near_pairs(texts)
    assert len(pairs) >= 5
    got = kept(spark, [(i, by_id[i], "en") for i in ids])
    assert got == [ids[i] for i in smallest_kept(texts, pairs)]
