"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

Every task packs the documents it reads, so no text is shuffled. A document's whole windows are cut
off first. What remains is cut into short pieces and collected until a group of windows is full.
The group is then divided: each piece starts as a partition of its own with all windows but one
empty; again and again the two partitions with the largest imbalance are merged, full windows of
one with empty windows of the other, until one partition with near-equal windows is left. If a
window is over capacity, the group is divided anew with one window more.

What a task has left at its end goes, but for whole windows, into sequences of 64, 128 ... tokens,
which need no padding.

Defined cases: null text is empty and has the end token alone; repeated rows are packed like any
others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import byte_slices, texts
from plaintlens.llm.pretokens import Numbers, Recent, spread

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Windows of a group, room left in each for imbalance, and the longest piece of a remainder.
GROUP_WINDOWS, ROOM, PIECE = 64, 6, 128
#: Text a task encodes at once, parts that the library encodes at once, and different parts kept in
#: a Python worker, which lives on between tasks and stages.
SLICE_BYTES, ENCODED, CACHED = 2 << 20, 4096, 1_000_000
#: The shortest sequence that a task's rest is cut into while there are windows for what is left.
SHORTEST = 64

_WORKER: dict = {}

Piece = tuple[int, int, bytes, int]  # doc_id, start, ids, doc_tokens


#: What vocabularies of this kind encode one by one (a fixed value).
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[list(b" \t\n\v\f\r")] = _SPACE
_KIND[[*b"abcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = _LETTER
_KIND[list(b"0123456789")] = _DIGIT
#: Words with these are left whole there.
_UNCUT = re.compile("['\x80-\xbf×÷\u2010-\u2027]")


def plain_parts(column: pa.Array) -> pa.ListArray:
    """The parts of lower-case texts in plain Latin letters, found by kinds of bytes.

    Words with an apostrophe, a sign beyond ASCII or the like stay whole.
    """
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    size = int(offsets[-1] - offsets[0])
    if not size:
        return pa.array([[]] * len(column), pa.list_(pa.string()))
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    kind = _KIND[data]
    before = np.append(np.uint8(_SPACE), kind[:-1])
    before[offsets[:-1][offsets[:-1] < size]] = _SPACE
    solid = kind != _SPACE
    first = solid & (before == _SPACE)
    new = solid & ((kind != before) | (kind == _DIGIT))
    odd = (data == 0x27) | (data == 0xC2) | (data == 0xE2)
    odd[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    odd = np.flatnonzero(odd)
    if len(odd):
        word = np.cumsum(first, dtype=np.int32)
        whole = np.zeros(word[-1] + 1, bool)
        whole[word[odd]] = True
        new &= first | ~whole[word]
    count = np.append(0, np.cumsum(new, dtype=np.int32))[offsets].astype(np.int32)
    text = np.ascontiguousarray(data[solid])
    starts = np.append(np.flatnonzero(new[solid]), len(text)).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(text))
    return pa.ListArray.from_arrays(pa.array(count), parts)


class WordEncoder:
    """Texts -> ids (little-endian unsigned 32 bits) as the tokenizers library gives them.

    This kind of vocabulary encodes lower-case letter runs, digits and symbol runs one by one, so
    the library encodes each different part once. Texts with characters beyond plain Latin ones,
    or with special strings, go to the library as they are.
    """

    #: Elsewhere composed forms are stable and the regex libraries agree.
    OTHER = r"[^\x{00}-\x{24F}\x{2010}-\x{2027}]|[\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{130}]|<\|"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # for parts that need no further normalising or cutting
        self.bare = Tokenizer(self.library.model)
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        parting = spec["pre_tokenizer"]["pretokenizers"][0]
        if steps != ["NFC", "Replace", "Lowercase"] or parting["pattern"]["Regex"] != PARTS:
            raise ValueError("only lower-case word vocabularies are supported")
        self.parts = Recent(CACHED)

    @staticmethod
    def _encoded(library, wanted: list[str]) -> list[bytes]:
        out = []
        for start in range(0, len(wanted), ENCODED):
            done = library.encode_batch_fast(
                wanted[start : start + ENCODED], add_special_tokens=False
            )
            out += [array("I", e.ids).tobytes() for e in done]
        return out

    def _new_parts(self, new: list[str]) -> list[bytes]:
        whole = [part for part in new if _UNCUT.search(part)]
        if not whole:
            return self._encoded(self.bare, new)
        found = dict(zip(whole, self._encoded(self.library, whole)))
        bare = [part for part in new if part not in found]
        found.update(zip(bare, self._encoded(self.bare, bare)))
        return [found[part] for part in new]

    def _of_parts(self, parts: pa.Array) -> Numbers:
        return self.parts.numbers(parts, self._new_parts)

    def __call__(self, column: pa.Array) -> list[bytes]:
        other = pc.match_substring_regex(column, self.OTHER)
        plain = pc.utf8_lower(pc.if_else(other, "", column))
        ids, ends = spread(plain_parts(plain), self._of_parts)
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        out = [raw[a:b] for a, b in zip([0, *ends], ends)]
        whole = np.flatnonzero(other.to_numpy(zero_copy_only=False))
        for i, encoded in zip(
            whole, self._encoded(self.library, [column[int(i)].as_py() for i in whole])
        ):
            out[i] = encoded
        return out


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for this file, made once."""
    if path not in _WORKER:
        _WORKER[path] = WordEncoder(path)
    return _WORKER[path]


def divide(weights: list[int], k: int) -> list[list[int]]:
    """Indices of ``weights`` in ``k`` near-equal parts, by multiway differencing.

    A partition is a list of (sum, members), largest first, its empty parts left out.
    """
    heap = [(-w, i, [(w, [i])]) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    turn = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) < len(b):
            a, b = b, a
        # the largest of b meet the smallest of a, empty ones first
        free = min(k - len(a), len(b))
        joined = a + b[:free]
        rest = b[free:]
        for j, (weight, members) in enumerate(rest):
            own, held = a[len(a) - 1 - j]
            joined[len(a) - 1 - j] = (own + weight, held + members)
        joined.sort(key=lambda x: -x[0])
        spread = joined[0][0] - (joined[-1][0] if len(joined) == k else 0)
        heapq.heappush(heap, (-spread, turn, joined))
        turn += 1
    return [members for _, members in heap[0][2]] if heap else []


def balanced(weights: list[int], capacity: int, windows: int = 1) -> list[list[int]]:
    """Parts with sums of at most ``capacity``: as few windows as differencing manages."""
    k = max(windows, -(-sum(weights) // capacity))
    while True:
        parts = divide(weights, k)
        if max((sum(weights[i] for i in p) for p in parts), default=0) <= capacity:
            return parts
        k += 1


class Packer:
    """Takes documents, gives sequences (lists of pieces); holds one group of windows."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.room = min(ROOM, capacity // 4)
        self.piece = min(PIECE, max(1, capacity // 8))
        self.held: list[Piece] = []
        self.tokens = 0

    def add(self, doc_id: int, ids: bytes) -> Iterator[list[Piece]]:
        total, cap = len(ids) // 4, self.capacity
        whole = total - total % cap
        for start in range(0, whole, cap):
            yield [(doc_id, start, ids[4 * start : 4 * (start + cap)], total)]
        full = GROUP_WINDOWS * (cap - self.room)
        start = whole
        while start < total:
            end = min(start + self.piece, total, start + full - self.tokens)
            self.held.append((doc_id, start, ids[4 * start : 4 * end], total))
            self.tokens += end - start
            start = end
            if self.tokens == full:
                yield from self._windows(self.held)
                self.held, self.tokens = [], 0

    def rest(self) -> Iterator[list[Piece]]:
        """The sequences of what is still held."""
        usual = self.capacity - self.room
        k, over = divmod(self.tokens, usual)
        # a few tokens a window still fit; more go into sequences that are a power of two long
        spread = over % SHORTEST if over % SHORTEST <= 2 * k else 0
        over -= spread
        while over:
            size = 1 << (over.bit_length() - 1)
            yield self._take(size)
            over -= size
        yield from self._windows(self.held)
        self.held, self.tokens = [], 0

    def _take(self, size: int) -> list[Piece]:
        out = []
        while size:
            doc_id, start, ids, total = self.held.pop()
            n = min(size, len(ids) // 4)
            if n < len(ids) // 4:
                self.held.append((doc_id, start, ids[: len(ids) - 4 * n], total))
                start, ids = start + len(ids) // 4 - n, ids[len(ids) - 4 * n :]
            out.append((doc_id, start, ids, total))
            size -= n
        return out

    def _windows(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        for part in balanced([len(p[2]) // 4 for p in pieces], self.capacity):
            yield [pieces[i] for i in part]


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32 bits), doc_tokens,
    sequence_id, offset. Sequences hold ``capacity`` tokens at most; a document's ids, the end
    token included, lie in exactly one piece each. A narrow map: repeated tasks give the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = word_encoder(path), Packer(capacity)
        number = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()

        def rows(sequences) -> pa.RecordBatch:
            nonlocal number
            found = []
            for sequence in sequences:
                offset = 0
                for doc_id, start, ids, total in sequence:
                    n = len(ids) // 4
                    found.append((doc_id, start, n, ids, total, number, offset))
                    offset += n
                number += 1
            names = [name.split()[0] for name in SCHEMA.split(", ")]
            columns = zip(names, list(zip(*found)) or [()] * len(names))
            return pa.RecordBatch.from_pydict(
                {c: pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in columns}
            )

        for batch in batches:
            for part in byte_slices(batch, "text", limit=SLICE_BYTES):
                encoded = encode(part.column("text"))
                ids_of = zip(part.column("doc_id").to_pylist(), encoded)
                yield rows(s for doc_id, ids in ids_of for s in packer.add(doc_id, ids + end))
        yield rows(packer.rest())

    return texts(docs).mapInArrow(run, SCHEMA)


def pack_digests(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    """``pack`` with the checksum of each piece's ids instead of the ids."""
    packed = pack(docs, path, capacity)
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
