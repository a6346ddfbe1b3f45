import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from plaintlens.llm.packing import Packer, balanced, divide, pack, pack_digests, word_encoder

PATH = P.path("word_bpe_49k.json")
EDGE = [
    None, "", " ", " x\x0b\x0cy ", "\n", "<|endoftext|>a<|STARTOFTEXT|> <|startoftext|>b", "İSTANBUL Σίσυφος ΟΔΟΣ",
    "é ́x", "a\x1cb\x85c\xa0d　e", "漢字12 3", "don't'S ''s !'s", "ÀÉÅ K", "word " * 9000, "x" * 30_000,
]


def library_ids(texts):
    found = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids + [1] for e in found]


def table(spark, texts):
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, offset int")


def check(rows, want, capacity=2048):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert sorted(docs) == list(range(len(want)))
    for i, pieces in docs.items():
        pieces.sort(key=lambda r: r.start)
        at = 0
        for r in pieces:
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want[i])
            ids = np.array(want[i][at : at + r.length], "<u4").tobytes()
            assert (bytes(r.ids) if "ids" in r else r.ids_crc32) == (ids if "ids" in r else zlib.crc32(ids))
            at += r.length
        assert at == len(want[i])
    padding = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / (sum(map(len, want)) + padding)


def test_given_documents_and_edge_cases(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    texts = EDGE + [r.text for r in rows]
    want = library_ids(texts)
    df = table(spark, texts).coalesce(2)
    assert check(pack(df, PATH).collect(), want) < 0.02
    assert check(pack_digests(df, PATH).collect(), want) < 0.02
    assert check(pack(df, PATH, capacity=50).collect(), want, 50) < 0.2


def test_pieces_of_one_text_only(spark):
    assert check(pack(table(spark, [None]), PATH).collect(), [[1]]) == 0
    assert pack(table(spark, []), PATH).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_division(seed):
    rng = random.Random(seed)
    weights = [rng.randint(1, 256) for _ in range(300)]
    parts = divide(weights, 16)
    assert sorted(i for p in parts for i in p) == list(range(300))
    sums = [sum(weights[i] for i in p) for p in parts]
    assert len(sums) == 16 and max(sums) - min(sums) <= 3
    assert divide([], 3) == [] and sorted(map(len, divide([5, 5, 5, 5], 2))) == [2, 2]


def test_windows_rise_when_capacity_is_exceeded():
    parts = balanced([7, 7, 7, 7, 7], 12)  # 35 tokens would fit in 3 windows, but no pair does
    assert len(parts) == 5


def test_a_packer_loses_nothing():
    rng = random.Random(1)
    packer, given, got = Packer(64), [], []
    for i in range(500):
        ids = rng.randbytes(4 * rng.randint(1, 200))
        given.append(ids)
        got += packer.add(i, ids)
    got += packer.rest()
    back = defaultdict(list)
    for sequence in got:
        assert sum(len(p[2]) for p in sequence) <= 4 * 64
        for doc_id, start, ids, _ in sequence:
            back[doc_id].append((start, ids))
    assert [b"".join(x for _, x in sorted(back[i])) for i in range(500)] == given


def test_encoder_equals_the_library():
    texts = [t or "" for t in EDGE]
    got = [np.frombuffer(x, "<u4").tolist() + [1] for x in word_encoder(PATH)(pa.array(texts))]
    assert got == library_ids(texts)
