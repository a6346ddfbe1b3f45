import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from plaintlens.llm.bpe_codec import PrefixEncoder, codec, encode_documents, round_trip
from plaintlens.llm.token_counts import counter, token_counts

EDGE = [
    None, "", "a", "aaaaaaa", "a" * 20_001, "  \n\n a", "<|endoftext|>x <|endoftext|>", "héé漢字 𝄞Ᲊ",
    "     ", "\x85\x1c\xa0" * 3, "ab" * 5000, "don't I'LL '", "֋՘ ౜",
]
RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


def noise(n, seed=1):
    rng = random.Random(seed)
    letters = "abcde '’\n\t.,1290ÀéßИ漢͸🙂"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def own():
    return codec(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def tik(own):
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=own.vocab.ranks, special_tokens={})


def table(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def given(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return [r.text for r in rows]


def test_counts_equal_the_library(spark):
    texts = EDGE + noise(500) + given(spark)
    library = Tokenizer.from_file(JSON)
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = {r.doc_id: r for r in token_counts(table(spark, texts), JSON, P.PATTERN).collect()}
    for i, text in enumerate(texts):
        size = len((text or "").encode())
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (want[i], size, want[i] > 1024)


def test_small_blocks_count_the_same(monkeypatch):
    texts = noise(300, 5)
    want = counter(JSON, P.PATTERN)(texts)
    monkeypatch.setattr("plaintlens.llm.token_counts.BLOCK_SYMBOLS", 7)
    monkeypatch.setattr("plaintlens.llm.token_counts._WORKER", {})
    assert counter(JSON, P.PATTERN)(texts) == want


def test_unsupported_files_are_refused():
    with pytest.raises(ValueError):
        counter(P.path("word_bpe_49k.json"), P.PATTERN)


def test_ids_equal_the_library_and_decode(spark, tik):
    texts = EDGE + noise(500, 2) + given(spark)
    got = {r.doc_id: r for r in round_trip(table(spark, texts), RANKS, P.PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = tik.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), digest)
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    listed = {r.doc_id: r.ids for r in encode_documents(table(spark, EDGE), RANKS, P.PATTERN).collect()}
    assert listed == {i: tik.encode_ordinary(t or "") for i, t in enumerate(EDGE)}


def test_other_vocabulary():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    tik = tiktoken.Encoding("m", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = noise(500, 3)
    assert codec(path, P.PATTERN).encode(texts) == [tik.encode_ordinary(t) for t in texts]


def test_appends_and_edits(own, tik):
    rng = random.Random(4)
    encoder, data = PrefixEncoder(own.vocab), b""
    whole = lambda b: tik._core_bpe.encode_single_piece(b)
    for _ in range(200):
        more = bytes(rng.choice(b"thereinga ") for _ in range(rng.randint(1, 4)))
        encoder.append(more)
        data += more
        assert encoder.ids() == whole(data)
        if rng.random() < 0.3:
            a = rng.randrange(len(data))
            b = min(len(data), a + rng.randint(0, 5))
            encoder.replace(a, b, b"on")
            data = data[:a] + b"on" + data[b:]
            assert encoder.ids() == whole(data) and encoder.data == data


def test_empty_tables(spark):
    assert token_counts(table(spark, []), JSON, P.PATTERN).collect() == []
    assert round_trip(table(spark, []), RANKS, P.PATTERN).collect() == []
