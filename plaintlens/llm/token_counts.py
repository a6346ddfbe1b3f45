"""Token counts by rank-synchronous merging of ragged arrays.

The different pre-tokens of a slice of text lie one behind the other in one array of symbols. In
every round each unfinished sequence applies its lowest-ranked pair wherever it occurs, all
sequences at once; sequences without a mergeable pair leave the array. What counts is the number
of symbols that survive.

Defined cases: null text has no tokens; rows are counted one by one, so ties and repeated rows
change nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plaintlens.llm.common import map_texts, texts
from plaintlens.llm.pretokens import Cache, library_splitter

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
NEVER = np.int64(1) << 40
#: Symbols that one run of the merge loop holds at most (a longer pre-token runs alone).
BLOCK_SYMBOLS = 2_000_000

_WORKER: dict = {}


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next of 256, 257 ..."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class MergeTable:
    """Symbol ids of bytes, and (left, right) -> (rank, symbol) as sorted arrays."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        self.size = max(vocab.values()) + 1
        self.of_byte = np.array([vocab[c] for c in byte_characters()], np.int64)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each piece after all merges."""
        out = np.zeros(len(pieces), np.int64)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out[lengths == 1] = 1
        todo = np.flatnonzero(lengths > 1)
        ends = np.cumsum(lengths[todo])
        start = 0
        while start < len(todo):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BLOCK_SYMBOLS, "right")))
            block = todo[start:stop]
            out[block] = self._merge([pieces[i] for i in block], lengths[block])
            start = stop
        return out

    def _merge(self, pieces: list[bytes], lengths: np.ndarray) -> np.ndarray:
        out = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        of = np.arange(len(pieces))  # the pieces that are still being merged
        starts = np.cumsum(lengths) - lengths
        ranks = self.rank_of(symbols, np.append(symbols[1:], 0))
        ranks[starts + lengths - 1] = NEVER
        while len(of):
            lowest = np.minimum.reduceat(ranks, starts)
            live = lowest < NEVER
            if not live.all():
                out[of[~live]] = lengths[~live]
                inside = np.repeat(live, lengths)
                symbols, ranks = symbols[inside], ranks[inside]
                of, lengths, lowest = of[live], lengths[live], lowest[live]
                if not len(of):
                    break
                starts = np.cumsum(lengths) - lengths
            hit = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            # of overlapping equal pairs (aaa) every second one counts, from the left
            first = np.append(True, np.diff(hit) != 1)
            run_start = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
            symbols[hit] = self.merged[ranks[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            stale = np.zeros(len(symbols), bool)  # symbols whose pair to the right is a new one
            stale[hit] = True
            stale[np.maximum(hit - 1, 0)] = True
            stale[np.maximum(hit - 2, 0)] |= ~keep[np.maximum(hit - 1, 0)]
            lengths = lengths - np.add.reduceat(~keep, starts)
            starts = np.cumsum(lengths) - lengths
            symbols, ranks, stale = symbols[keep], ranks[keep], np.flatnonzero(stale[keep])
            ranks[stale] = self.rank_of(symbols[stale], symbols[np.minimum(stale + 1, len(symbols) - 1)])
            ranks[starts + lengths - 1] = NEVER
        return out


def counter(path: str, pattern: str) -> Callable[[list[str]], list[int]]:
    """Texts -> token counts, for a byte-level BPE file of the tokenizers library.

    Added tokens found in a text are one token each, as is that library's default.
    """
    key = (path, pattern)
    if key not in _WORKER:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        flags = ("single_word", "lstrip", "rstrip", "normalized")
        if spec["normalizer"] or any(t[x] for t in spec["added_tokens"] for x in flags):
            raise ValueError("only plain byte-level files without normalizer are supported")
        specials = [t["content"] for t in spec["added_tokens"]]
        _WORKER[key] = (
            MergeTable(spec["model"]["vocab"], spec["model"]["merges"]),
            specials,
            library_splitter(pattern),
            Cache(),
        )
    table, specials, split, cache = _WORKER[key]

    def count(batch: list[str]) -> list[int]:
        pieces, extra = [], []
        for text in batch:
            parts = [text]
            for special in specials:
                parts = [p for part in parts for p in part.split(special)]
            extra.append(len(parts) - 1)
            pieces.append(split(text) if len(parts) == 1 else [x for p in parts for x in split(p)])
        new = cache.missing(x for one in pieces for x in one)
        cache.update(zip(new, table.count([x.encode() for x in new]).tolist()))
        return [sum(map(cache.__getitem__, one)) + e for one, e in zip(pieces, extra)]

    return count


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 1024) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. A narrow map, no shuffle.

    ``path`` names the vocabulary file; it is read once a worker and must be there on each.
    """

    def make():
        count = counter(path, pattern)

        def work(_, batch: list[str]) -> dict:
            n = count(batch)
            return {
                "n_bytes": pa.array([len(t.encode()) for t in batch], pa.int64()),
                "n_tokens": pa.array(n, pa.int64()),
                "over_limit": pa.array([x > limit for x in n], pa.bool_()),
            }

        return work

    return map_texts(texts(docs), make, SCHEMA)
