"""Splitting text into the pieces that a byte-level vocabulary encodes one by one."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Up to this code point the `regex` module and the tokenizers library class letters, numbers and
#: spaces alike; their Unicode versions differ further up.
AGREED = 0x52F
_BEYOND = regex.compile(r"[^\u0000-ԯ]")


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Pieces as the tiktoken library makes them."""
    return regex.compile(pattern).findall


def library_splitter(pattern: str) -> Callable[[str], list[str]]:
    """Pieces as the tokenizers library makes them: by the fast module where both agree."""
    from tokenizers import Regex, pre_tokenizers

    fast = regex.compile(pattern).findall
    own = pre_tokenizers.Split(Regex(pattern), "isolated")

    def split(text: str) -> list[str]:
        if _BEYOND.search(text):
            return [piece for piece, _ in own.pre_tokenize_str(text)]
        return fast(text)

    return split


class Cache(dict):
    """Results by piece, emptied when full, so a worker's memory stays bounded."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def missing(self, pieces) -> list:
        """The pieces not held, after making room for them."""
        wanted = set(pieces)
        new = wanted - self.keys()
        if len(self) + len(new) > self.limit:
            self.clear()
            new = wanted
        return list(new)


Numbers = tuple[np.ndarray, np.ndarray]


def spread(parts: pa.ListArray, numbers_of: Callable[[pa.Array], Numbers]) -> Numbers:
    """Numbers of texts from those of their different parts.

    Both are given as all numbers one behind the other, and the end of each text's or part's own.
    """
    coded = parts.flatten().dictionary_encode()
    flat, stops = numbers_of(coded.dictionary)
    starts = np.append(0, stops[:-1])
    at = coded.indices.to_numpy()
    n = (stops - starts)[at]
    ends = np.cumsum(n)
    source = np.repeat(starts[at] - (ends - n), n)
    source += np.arange(len(source))
    offsets = parts.offsets.to_numpy()
    return flat[source], np.append(0, ends)[offsets[1:] - offsets[0]]


def joined(blobs: list[bytes]) -> Numbers:
    """Byte strings of 4-byte numbers as ``spread`` takes them."""
    stops = np.cumsum(np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4)
    return np.frombuffer(b"".join(blobs), "<u4"), stops


class Recent:
    """4-byte numbers of pieces of text, kept in arrays: tens of bytes a piece, not hundreds as
    Python objects. When full, those not asked for again since it was last full go."""

    #: Longer pieces are not kept.
    LONGEST = 256

    def __init__(self, limit: int):
        self.limit = limit
        self._keep(pa.array([], pa.string()), np.empty(0, "<u4"), np.empty(0, np.int64))

    def _keep(self, pieces: pa.Array, flat: np.ndarray, own: np.ndarray, which=None) -> None:
        if which is not None:
            pieces, flat, own = pieces.filter(pa.array(which)), flat[np.repeat(which, own)], own[which]
        self.pieces, self.flat, self.own = pieces, flat, own
        self.used = np.zeros(len(pieces), bool)

    def numbers(self, wanted: pa.Array, encode: Callable[[list[str]], list[bytes]]) -> Numbers:
        """As ``spread`` takes them, of different pieces; ``encode`` gives those not held."""
        at = pc.index_in(wanted, value_set=self.pieces)
        self.used[at.drop_null().to_numpy()] = True
        if len(self.pieces) + at.null_count > self.limit:
            many = 2 * self.used.sum() > self.limit
            self._keep(self.pieces, self.flat, self.own, self.used & (not many))
            at = pc.index_in(wanted, value_set=self.pieces)
        new = wanted.filter(at.is_null())
        at = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        if len(new):
            flat, stops = joined(encode(new.to_pylist()))
            at[at < 0] = np.arange(len(self.pieces), len(self.pieces) + len(new))
            self.pieces = pa.concat_arrays([self.pieces, new])
            self.flat = np.append(self.flat, flat)
            self.own = np.append(self.own, np.diff(stops, prepend=0))
            self.used = np.append(self.used, np.zeros(len(new), bool))
        n = self.own[at]
        ends = np.cumsum(n)
        source = np.repeat((np.cumsum(self.own) - self.own)[at] - (ends - n), n)
        found = self.flat[source + np.arange(len(source))]
        if len(new):
            short = pc.less_equal(pc.binary_length(self.pieces), self.LONGEST).to_numpy(zero_copy_only=False)
            if not short.all():
                used = self.used[short]
                self._keep(self.pieces, self.flat, self.own, short)
                self.used = used
        return found, ends
