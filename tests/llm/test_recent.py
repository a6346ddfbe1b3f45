"""Numbers of pieces kept by a worker: right, bounded, and small."""

import tracemalloc

import numpy as np
import pyarrow as pa

from plaintlens.llm.packing import WordEncoder
from plaintlens.llm.pretokens import Recent


def blobs(pieces):
    return [np.frombuffer(p.encode(), np.uint8).astype("<u4").tobytes() for p in pieces]


def test_numbers_of_any_calls():
    kept, asked = Recent(50), 0

    def encode(pieces):
        nonlocal asked
        asked += len(pieces)
        return blobs(pieces)

    rng = np.random.default_rng(3)
    for size in (0, 1, 30, 7, 45, 200, 3, 30, 30, 0, 12):
        own = [f"{'x' * 300 if i % 17 == 0 else 'w'}{i}" if i else "" for i in rng.choice(400, size, replace=False)]
        flat, stops = kept.numbers(pa.array(own, pa.string()), encode)
        assert flat.tobytes() == b"".join(blobs(own))
        assert stops.tolist() == np.cumsum([len(p) for p in own], dtype=int).tolist()
        assert len(kept.pieces) <= 50 + size and all(len(p.as_py()) <= Recent.LONGEST for p in kept.pieces)
    before = asked
    frequent = pa.array([f"f{i}" for i in range(10)])
    for i in range(20):  # what is asked for again and again stays
        kept.numbers(frequent, encode)
        kept.numbers(pa.array([f"r{i}-{j}" for j in range(10)]), encode)
    assert asked - before <= 30 + 200


def test_a_kept_part_takes_tens_of_bytes():
    encode = WordEncoder("/opt/tokenizers/word_bpe_49k.json")
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(letters[i // 26**k % 26] for k in range(4)) + "ing" for i in range(60_000)]
    encode(pa.array(words[:10]))
    tracemalloc.start()
    arrow = pa.total_allocated_bytes()
    for start in range(0, len(words), 10_000):
        encode(pa.array([" ".join(words[start : start + 10_000])]))
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert held < 80 * len(words)
