"""Cross-tokenizer alignment against a plain version of the contract, and fragment composition."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from plaintlens.llm.alignment import a_table, align, b_table, fragments, tokenized

A = "/opt/tokenizers/byte_bpe_50k.json"
B = "/opt/tokenizers/piece_bpe_32k.model"


def streams(text):
    tok, ba = a_table(A)
    sp, bb = b_table(B)
    ia = tok.encode(" " + text, add_special_tokens=False).ids
    ib = sp.encode(text)
    want = (" " + text).encode()
    pa_, pb_ = [ba[i] for i in ia], [bb[i] for i in ib]
    if not text or None in pb_ or b"".join(pa_) != want or b"".join(pb_) != want:
        return None
    ends = lambda ps: np.cumsum([len(p) for p in ps])
    return ia, list(ends(pa_)), ib, list(ends(pb_))


def brute(docs):
    per, links = [], Counter()
    for doc_id, text in docs:
        s = streams(text or "")
        if s is None:
            per.append((doc_id, 0, 0, [], ""))
            continue
        ia, ea, ib, eb = s
        cuts = sorted(set(ea) & set(eb))
        groups, la, lb = [], 0, 0
        doc_links = []
        for c in cuts:
            ga = [i for i, e in zip(ia, ea) if la < e <= c]
            gb = [i for i, e in zip(ib, eb) if lb < e <= c]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            doc_links.append((ga[-1], gb[-1]))
            la = lb = c
        links.update(doc_links)
        per.append((doc_id, len(ia), len(ib), doc_links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = Counter()
    for (a, b), n in links.items():
        top[b] = max(top[b], n)
    out = []
    for doc_id, na, nb, dl, digest in per:
        out.append((doc_id, na, nb, len(dl), len(dl), sum(links[l] == top[l[1]] for l in dl), sum(links[l] for l in dl), digest))
    return sorted(out, key=repr)


TEXTS = [
    "Hello world, this is a test.",
    "Hello world again",
    "double  space breaks the second tokenizer",
    "ñandú café <s> </s> <|endoftext|> [INST]",
    None,
    "",
    "x",
    "Hello world, this is a test.",
]


@pytest.mark.parametrize("chunk", [7, 64 << 10])
def test_against_brute_force(spark, chunk):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[0]), (None, "a b c")]
    long = " ".join(f"word{i} and more" for i in range(300))
    docs.append((99, long))
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS row", "'x' AS frag", "2 AS k")
    got = sorted((tuple(r) for r in align(df, A, B, chunk).collect()), key=repr)
    assert got == brute(docs)


def test_fragments_compose_to_the_whole():
    s = streams(" ".join(f"w{i}x" for i in range(50)))
    ia, ea, ib, eb = (np.array(x, np.int64) for x in s)
    whole = fragments(ia, ea, ib, eb, 1 << 30)
    assert len(whole) == 1 and whole[0]["cut"] and whole[0]["ta"] == []
    parts = fragments(ia, ea, ib, eb, 5)
    assert len(parts) > 10
    assert sum(len(p["links"]) for p in parts) == len(whole[0]["links"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align(df, A, B).collect() == []


SPACED = [
    " leading", "trailing ", "two  spaces", "   many   spaces   ", "tab\t next", "line\n next\n\n  and more", " ", "  ", "\n", " \n ",
    "it's they'll 'tis a'b", "  nbsp  x", "᠎  x", "　 wide  　", "a▁b ▁", "日本語 テキスト と", "x" * 200 + " y",
    "émoji 😀 😀😀 <unk> <s>", "1234 5678,90 $5.00 !!", "\x1c x\x85 y", "CRLF\r\n next",
]


@pytest.mark.parametrize("chunk", [1, 7, 64 << 10])
def test_words_align_on_their_own(spark, chunk):
    """Segments encoded alone give what the whole text gives, whatever the white space."""
    docs = list(enumerate(SPACED)) + [(100, " ".join(SPACED)), (101, "\n".join(SPACED)), (102, "one two " * 50)]
    got = sorted((tuple(r) for r in align(spark.createDataFrame(docs, "doc_id long, text string"), A, B, chunk).collect()), key=repr)
    assert got == brute(docs)


def test_only_long_texts_store_groups(spark):
    docs = spark.createDataFrame([(1, "a b c", 0), (2, "long text " * 40, 1)], "doc_id long, text string, row long")
    rows = tokenized(docs, A, B, 100).collect()
    assert {r.doc_id for r in rows if r.frag is not None} == {2}
    assert all(r.digest and len(r.links) == 3 for r in rows if r.doc_id == 1)


def test_new_segments_reach_the_libraries_in_bounded_groups(monkeypatch):
    import pyarrow as pa

    from plaintlens.llm import alignment

    encoder, sizes = alignment.Encoder(A, B), []

    class Watched:
        def encode(self, parts, **options):
            sizes.append(len(parts))
            return sp.encode(parts, **options)

    sp, encoder.sp = encoder.sp, Watched()
    text = " ".join(f"w{i}" for i in range(12_000))
    batch = pa.RecordBatch.from_pydict({"row": [0], "doc_id": [1], "text": [text]})
    (out,) = alignment._aligned(encoder, batch, 1 << 20)
    assert sum(sizes) == 12_000 and max(sizes) <= alignment.ENCODED_PARTS
    ia, _, ib, _ = streams(text)
    assert (out.column("n_a")[0].as_py(), out.column("n_b")[0].as_py()) == (len(ia), len(ib))


def test_batches_are_bounded_while_texts_are_encoded(spark):
    from plaintlens.llm.common import arrow_batches

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    with arrow_batches(spark, 1 << 16):
        docs = spark.range(0, 200, 1, 1).selectExpr("repeat('x', 10000) AS text")
        sizes = docs.mapInArrow(lambda bs: (b.slice(0, 1) for b in bs), "text string").count()
    assert sizes > 20 and spark.conf.get(name, None) == before
