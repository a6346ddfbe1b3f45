"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

Every byte prefix of a pre-token has exactly one valid last token: the one that ends its encoding.
``PrefixEncoder`` stores that token for each prefix. The token at the end of a longer prefix is
found by looking back only: a vocabulary entry that ends here fits if it may stand behind the last
token of the prefix before it. So appending bytes, or encoding a word that begins like the one
before, reuses every stored prefix; an edit invalidates only the prefixes behind it.

Two tokens may stand side by side if merging their joined bytes from scratch never merges across
the border between them, which is decided by undoing their own merges step by step.

Defined cases: null text has no tokens; rows are encoded one by one, so ties and repeated rows
change nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plaintlens.llm.common import map_texts, texts
from plaintlens.llm.pretokens import Cache, splitter

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NEVER = 1 << 60
#: Remembered answers of the border test.
BORDERS = 1_000_000

_WORKER: dict = {}


class Vocabulary:
    """Token bytes by id, ranks, and how each token came about by its last merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        tails: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 2:
                tails.setdefault(token[-3:], set()).add(len(token))
        # the lengths that entries with these last three bytes have, longest first
        self.lengths = {tail: (*sorted(of, reverse=True), 2, 1) for tail, of in tails.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.borders: dict[int, bool] = {}
        # the ids that encoding can give at all
        self.reachable = {i for b, i in ranks.items() if len(b) == 1}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left in self.reachable and right in self.reachable:
                    if self._survives(left, right, rank):
                        self.split[rank] = (left, right)
                        self.reachable.add(rank)
                        break

    def _survives(self, left: int, right: int, before: int) -> bool:
        """True if no merge crosses the border before merges of rank ``before`` are applied."""
        ranks, names, split = self.ranks, self.bytes_of, self.split
        while True:
            if ranks.get(names[left] + names[right], NEVER) < before:
                return False
            made_left, made_right = left in split, right in split
            # go back to where the younger of the two was made; of one rank, the left came first
            if made_left and (not made_right or left > right):
                before, left = left, split[left][1]
            elif made_right:
                # the border pair stands left of the pair undone, so it wins a tie
                before, right = right + 1, split[right][0]
            else:
                return True

    def side_by_side(self, left: int, right: int) -> bool:
        key = (left << 32) | right
        if len(self.borders) >= BORDERS:
            self.borders.clear()
        known = self.borders[key] = self._survives(left, right, NEVER)
        return known


class PrefixEncoder:
    """The last token of every prefix of ``data``; grows by ``append``, shrinks by ``truncate``."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.data = b""
        self.last: list[int] = []  # last[i] ends the encoding of data[: i + 1]

    def truncate(self, length: int) -> None:
        self.data = self.data[:length]
        del self.last[length:]

    def append(self, more: bytes) -> None:
        data = self.data = self.data + more
        vocab, last = self.vocab, self.last
        ranks, lengths, borders = vocab.ranks, vocab.lengths, vocab.borders
        for end in range(len(last) + 1, len(data) + 1):
            for length in lengths.get(data[max(0, end - 3) : end], (2, 1)):
                start = end - length
                if start < 0:
                    continue
                token = ranks.get(data[start:end])
                if token is None:
                    continue
                if start == 0:
                    fits = token in vocab.reachable
                else:
                    before = last[start - 1]
                    fits = borders.get((before << 32) | token)
                    if fits is None:
                        fits = vocab.side_by_side(before, token)
                if fits:
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def set(self, data: bytes) -> None:
        """Encode ``data``, keeping the prefixes that it shares with what is stored."""
        old, same = self.data, 0
        most = min(len(old), len(data))
        while same < most and old[same] == data[same]:
            same += 1
        self.truncate(same)
        self.append(data[same:])

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Re-encode after an edit of data[start:stop]: only what follows ``start`` is redone."""
        self.set(self.data[:start] + new + self.data[stop:])

    def ids(self) -> list[int]:
        """The encoding, read off from its end."""
        out, end, size = [], len(self.last), self.vocab.bytes_of
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(size[token])
        return out[::-1]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """Whole texts to ids and back, for a rank file and a pattern of pre-tokens."""

    def __init__(self, path: str, pattern: str):
        self.vocab = Vocabulary(read_ranks(path))
        self.split = splitter(pattern)
        self.cache = Cache()
        self.encoder = PrefixEncoder(self.vocab)
        self.names = {i: str(i) for i in self.vocab.bytes_of}

    def encode(self, batch: list[str]) -> list[list[int]]:
        pieces = [self.split(text) for text in batch]
        encoder = self.encoder
        # in byte order neighbours share long prefixes
        for data, piece in sorted((p.encode(), p) for p in self.cache.missing(chain(*pieces))):
            encoder.set(data)
            self.cache[piece] = array("I", encoder.ids()).tobytes()
        encoder.truncate(0)
        found = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(found, one)), np.uint32).tolist() for one in pieces]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.bytes_of.__getitem__, ids))


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for this file, made once."""
    if (path, pattern) not in _WORKER:
        _WORKER[path, pattern] = Codec(path, pattern)
    return _WORKER[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text. A narrow map, no shuffle."""

    def make():
        own = codec(path, pattern)
        return lambda _, batch: {"ids": pa.array(own.encode(batch), pa.list_(pa.int32()))}

    return map_texts(texts(docs), make, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: digests of its ids and of the bytes that the ids decode to."""

    def make() -> Callable:
        own = codec(path, pattern)

        def work(_, batch: list[str]) -> dict:
            encoded = own.encode(batch)
            listed = (" ".join(map(own.names.__getitem__, ids)) for ids in encoded)
            return {
                "n_tokens": pa.array(map(len, encoded), pa.int64()),
                "ids_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in listed],
                "decoded_sha256": [hashlib.sha256(own.decode(x)).hexdigest() for x in encoded],
            }

        return work

    return map_texts(texts(docs), make, SCHEMA)
