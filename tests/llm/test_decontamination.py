"""Winnowing decontamination against a brute force over every window of every item."""

import hashlib
import re

import pytest

from plaintlens.llm.decontamination import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = []
    for item_id, text in items:
        w = words(text)
        size = min(10, len(w))
        for s in range(len(w) - size + 1 if w else 0):
            windows.append((item_id, tuple(w[s : s + size])))
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item_id, win in windows:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p : p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    found.add(item_id)
        ids = ",".join(sorted(str(i) for i in found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0))
    return sorted(out, key=repr)


def run(spark, docs, items, extra=False):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    if extra:  # columns whose names clash with the operator's own
        d = d.selectExpr("*", "1 AS w", "2 AS fps", "'x' AS h", "3 AS n")
        b = b.selectExpr("*", "1 AS w", "2 AS m", "3 AS L")
    got = decontaminate(d, b).collect()
    return sorted((tuple(r) for r in got), key=repr)


ITEM = "The quick brown fox jumps over the lazy dog near the river bank today at noon"


@pytest.mark.parametrize("extra", [False, True])
def test_against_brute_force(spark, extra):
    items = [(1, ITEM), (2, "alpha beta gamma"), (3, None), (4, "one two three four five six seven eight nine ten eleven"), (4, "Zeta eta theta")]
    docs = [
        (10, "x " + ITEM + " y"),
        (11, "THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG NEAR"),  # one window, upper case
        (12, "quick brown fox jumps over the lazy dog near the"),  # a window of item 1 shifted
        (13, "alpha beta gamma alpha beta"),  # the short item twice
        (14, "alpha, beta; gamma! zeta eta theta"),
        (15, None),
        (16, ""),
        (17, "unrelated words " * 50),
        (18, "one two three four five six seven eight nine ten eleven " * 3),
        (18, "one two three four five six seven eight nine ten eleven " * 3),  # repeated row
        (None, "alpha beta gamma"),
        (19, "ñandú café alpha beta gamma ñandú"),
    ]
    assert run(spark, docs, items, extra) == brute(docs, items)


def test_long_items_only_and_long_text(spark):
    items = [(7, ITEM), (8, " ".join(f"w{i}" for i in range(40)))]
    body = " ".join(f"w{i}" for i in range(5000))
    docs = [(1, body), (2, body[:200] + " " + ITEM), (3, "w3 w4 w5 w6 w7 w8 w9 w10 w11")]  # nine words: no window
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, ITEM)]) == []
    docs = [(1, ITEM), (2, None)]
    assert run(spark, docs, []) == brute(docs, [])
