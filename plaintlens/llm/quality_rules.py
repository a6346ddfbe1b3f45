"""Quality rules: word and symbol counts, and compression bands by zstandard.

A text passes the bands when its compression ratio (compressed bytes / bytes) as a whole, and the
ratios of its fixed chunks, stay inside limits that depend on its length. Repetitive text shrinks
too well, noise does not shrink. Texts under 4,096 bytes have chunks of 512 bytes; where whole
chunks leave a rest, one more chunk ends at the end of the text.

Defined cases: null text has no words and fails the base rule; texts too short for a band are
judged by the base rule alone; rows are judged one by one, so ties and repeated rows change
nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from plaintlens.llm.common import map_texts, texts

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
WINDOW = 8

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, n_bytes long, whole_ratio double, "
    "n_chunks long, n_low_chunks long, n_high_chunks long, reason string"
)


@dataclass(frozen=True)
class Bands:
    """(at least so many bytes, lowest ratio, highest ratio) in rising order of bytes; the last
    entry that a text reaches holds. The highest ratios lie between prose and base64. Chunks have
    limits of their own for each size, and a text fails when more than ``chunk_share`` of its
    chunks lie outside them."""

    whole: tuple = (
        (200, 0.08, 0.90), (300, 0.08, 0.80), (400, 0.08, 0.78), (512, 0.08, 0.76), (1_000, 0.08, 0.72),
        (2_000, 0.08, 0.70), (10_000, 0.06, 0.68), (100_000, 0.05, 0.62),
    )
    chunk_bytes: int = 4_096
    chunk: tuple = (0.08, 0.72)
    short_bytes: int = 512  # chunks of texts that are shorter than one of chunk_bytes
    short: tuple = (0.08, 0.78)
    chunk_share: float = 0.25
    level: int = 3


def repeat_words(words: list[bytes], ids: dict[bytes, int]) -> int:
    """Words inside a window of eight that occurs twice or more in the text, first included.

    Windows are named exactly: ids of words are joined in pairs, pairs in fours, fours in eights.
    """
    n = len(words)
    if n < WINDOW + 1:
        return 0
    names = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    names = np.unique(names, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < WINDOW:
        joined = names[:-step] * n + names[step:]  # each below n: no two pairs share a product
        if step * 2 == WINDOW:
            break
        names = np.unique(joined, return_inverse=True)[1].astype(np.int64)
        step *= 2
    order = np.argsort(joined, kind="stable")
    same = joined[order[1:]] == joined[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(joined), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return int((np.cumsum(change[:n]) > 0).sum())


def band_of(bands: Bands, n_bytes: int) -> tuple[float, float] | None:
    found = [(low, high) for least, low, high in bands.whole if n_bytes >= least]
    return found[-1] if found else None


def judge(text: str, bands: Bands, zstd: zstandard.ZstdCompressor) -> tuple:
    """The result columns of one text, doc_id left out."""
    raw = text.encode()
    words = raw.split()
    n_words = len(words)
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    n_repeat = repeat_words(words, {})
    failed = n_words < 20 or 100 * n_repeat > 30 * n_words
    ratio = len(zstd.compress(raw)) / len(raw) if raw else None
    short = len(raw) < bands.chunk_bytes
    size, limits = (bands.short_bytes, bands.short) if short else (bands.chunk_bytes, bands.chunk)
    chunks = [raw[i : i + size] for i in range(0, len(raw) - size + 1, size)]
    if chunks and len(raw) % size:
        chunks.append(raw[-size:])
    shares = [len(zstd.compress(c)) / size for c in chunks]
    low = sum(x < limits[0] for x in shares)
    high = sum(x > limits[1] for x in shares)
    band = band_of(bands, len(raw))
    reason = None
    if failed:
        reason = "base"
    elif band and ratio < band[0]:
        reason = "repetitive"
    elif band and ratio > band[1]:
        reason = "incompressible"
    elif low > bands.chunk_share * len(shares):
        reason = "repetitive chunks"
    elif high > bands.chunk_share * len(shares):
        reason = "incompressible chunks"
    return (
        n_words,
        len(text) - sum(raw.count(s) for s in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")),
        sum(raw.count(bytes([s])) for s in SYMBOLS),
        len(lines) - len(set(lines)),
        n_repeat,
        failed,
        reason is None,
        len(raw),
        ratio,
        len(shares),
        low,
        high,
        reason,
    )


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document with its counts, ratios and verdict; a narrow map, no shuffle."""
    names = [part.strip().split(" ")[0] for part in SCHEMA.split(",")][1:]
    strings = {"reason": pa.string(), "whole_ratio": pa.float64()}
    flags = {"base_failed": pa.bool_(), "kept": pa.bool_()}

    def make():
        zstd = zstandard.ZstdCompressor(level=bands.level)

        def work(_, batch: list[str]) -> dict:
            rows = list(zip(*(judge(t, bands, zstd) for t in batch))) or [()] * len(names)
            return {
                name: pa.array(column, (strings | flags).get(name, pa.int64()))
                for name, column in zip(names, rows)
            }

        return work

    return map_texts(texts(docs), make, SCHEMA)
