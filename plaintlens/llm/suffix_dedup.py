"""Suffix-array dedup: remove every byte of a 100-byte string that also starts earlier.

Sorting all suffixes of a corpus would move each byte a hundred times. A sparse suffix array gives
the same result. In every 100-byte window the smallest hash of its 32-byte substrings, the leftmost
of equals, marks an anchor; equal windows have their anchor at the same place. So only suffixes at
anchors are compared, each together with the windows it answers for:

1. Anchors are found document by document. Those with equal surroundings (a 64-bit hash of the
   anchor's 32 bytes and one of all bytes its windows cover) form a class; all but the first of a
   class repeat it. Suffixes whose 32 bytes occur nowhere else are settled here. Classes are formed
   where the text is read first, so a passage in a third of all documents sends one record a task.
2. What is left, the first of each class where several share 32 bytes, goes to the suffix array:
   splitters sampled from the anchors deal the suffixes into ranges of leading bytes.
3. Each bucket is sorted by multikey quicksort (eight-byte tokens), once by the bytes from the
   anchor on and once by the bytes before it, backwards. Common prefix lengths then give, for every
   distance of a window from its anchor, the classes of equal windows; all but the first repeat.
4. A run of equal leading bytes too large for one bucket is dealt over several; the windows that
   were first in their own bucket are then compared across the boundaries.

Defined cases: null text is empty; texts under 100 bytes lose nothing; overlapping repeats count;
a null doc_id comes before any other; rows that share a doc_id are documents of their own, ordered
by text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaintlens.llm.common import task_count, texts, written

LENGTH, CORE = 100, 32
REACH = LENGTH - CORE + 1  # anchors that a window chooses from
#: Odd multiplier of the rolling hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)



@dataclass(frozen=True)
class Sizes:
    """What a task holds at once; none of it changes the result."""

    slice: int = 1 << 20  # window starts scanned together
    records: int = 500_000  # anchors compared where they are read before they are dealt out
    bucket_bytes: int = 16 << 20  # text that a part of the records or a bucket stands for
    sample: int = 20_000  # suffixes sampled for splitters, of a corpus of any size


REMOVED, COMPARE, SAMPLED, RECORD = 0, 1, 2, 3
FOUND = "part int, kind int, key long, data binary"
FIELDS = (("core", "<u8"), ("around", "<u8"), ("key", "<i8"), ("at", "<u4"), ("low", "u1"), ("high", "u1"), ("known", "u1"))
RECORD_BYTES = sum(np.dtype(t).itemsize for _, t in FIELDS)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class AnchorFinder:
    """Anchors of a run of texts with the range of windows that each answers for."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def __call__(self, data: np.ndarray, windows: np.ndarray):
        """``windows`` marks the positions where a window may start. Returns, an entry an anchor:
        position, first window, last window, hash of its core, hash of all bytes covered."""
        n = len(data)
        if len(self.up) < n + 1:
            self.up, self.down = powers(_BASE, n + 1), powers(_BACK, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        hashes = _mixed((sums[CORE:] - sums[:-CORE]) * self.down[: n - CORE + 1])
        least, place, span = hashes, np.arange(len(hashes), dtype=np.int32), 1
        while span < REACH:  # least of the next `span` hashes, doubled each time
            step = min(span, REACH - span)
            later = least[step:] < least[:-step]
            place = np.where(later, place[step:], place[:-step])
            least = np.where(later, least[step:], least[:-step])
            span += step
        starts = np.flatnonzero(windows[: len(place)])
        chosen = place[starts].astype(np.int64)
        if not len(chosen):
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
        new = np.append(True, (chosen[1:] != chosen[:-1]) | (np.diff(starts) != 1))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(chosen)) - 1
        at, low, high = chosen[first], starts[first], starts[last]
        around = (sums[high + LENGTH] - sums[low]) * self.down[low]
        shape = ((at - low) << 8 | (high - low)).astype(np.uint64)
        return at, low, high, hashes[at], _mixed(around + shape * np.uint64(0xD6E8FEB86659FD93))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def segments(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, bytes]]:
    """(key, offset, bytes): texts cut so that each part has ``size`` window starts at most."""
    for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
        raw = text.encode()
        for start in range(0, max(0, len(raw) - LENGTH + 1), size):
            yield key, start, raw[start : start + size + LENGTH - 1]


def packed(*columns: np.ndarray) -> np.ndarray:
    """Rows of 64-bit numbers."""
    return np.ascontiguousarray(np.stack(columns, axis=1).astype("<i8"))


def by_key(kind: int, keys: np.ndarray, rows: np.ndarray, parts: int) -> pa.RecordBatch:
    """One result row per key with its rows of numbers."""
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys
    last = np.append(first[1:], len(keys))
    return found_rows(
        keys[first] % parts, kind, keys[first], [rows[a:b].tobytes() for a, b in zip(first, last)]
    )


def found_rows(parts, kind: int, keys, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.asarray(parts, np.int32)),
            pa.array(np.full(len(data), kind, np.int32)),
            pa.array(np.asarray(keys, np.int64)),
            pa.array(data, pa.binary()),
        ],
        names=["part", "kind", "key", "data"],
    )


def classed(records: dict[str, np.ndarray]):
    """Sort by core, surroundings, place; (order, first of core, first of class) as arrays."""
    order = np.lexsort([records[f] for f in ("at", "key", "around", "core")])
    core, around = records["core"][order], records["around"][order]
    new_core = np.append(True, core[1:] != core[:-1])
    new_class = new_core | np.append(True, around[1:] != around[:-1])
    return order, new_core, new_class


def windows_of(records: dict[str, np.ndarray]) -> np.ndarray:
    """(first window, number of windows) of each record."""
    low = records["at"].astype(np.int64) - records["low"]
    return packed(low, records["low"].astype(np.int64) - records["high"] + 1)


def anchors_of(records: dict[str, np.ndarray]) -> np.ndarray:
    return packed(records["at"], records["low"], records["high"])


def _picked(records: dict[str, np.ndarray], which) -> dict[str, np.ndarray]:
    return {name: column[which] for name, column in records.items()}


def find_anchors(keyed: DataFrame, parts: int, sample_share: float, sizes: Sizes) -> DataFrame:
    """Records dealt out by core, and what can be settled where the text is read."""
    limit = np.uint64(min(int(sample_share * 2.0**64), 2**64 - 1))

    def settled(records: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        order, new_core, new_class = classed(records)
        records = _picked(records, order)
        repeat = _picked(records, ~new_class)
        yield by_key(REMOVED, repeat["key"], windows_of(repeat), parts)
        classes = _picked(records, new_class)
        core_of = np.cumsum(new_core)[new_class] - 1
        several = np.bincount(core_of)[core_of] > 1
        compare = _picked(classes, several)
        yield by_key(COMPARE, compare["key"], anchors_of(compare), parts)
        # one record tells the other tasks of this core
        classes["known"] = several.astype(np.uint8)
        sent = _picked(classes, new_core[new_class])
        part = (sent["core"] % np.uint64(parts)).astype(np.int64)
        order = np.lexsort([sent["at"], sent["key"], part])
        sent, part = _picked(sent, order), part[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        last = np.append(first[1:], len(part))
        blobs = [
            b"".join(sent[name][a:b].astype(t).tobytes() for name, t in FIELDS)
            for a, b in zip(first, last)
        ]
        yield found_rows(part[first], RECORD, np.zeros(len(first)), blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, held, n_held = AnchorFinder(), [], 0

        def scanned(group) -> tuple[dict, list]:
            data = np.frombuffer(b"".join(x[2] for x in group), np.uint8)
            length = np.array([len(x[2]) for x in group])
            begin = np.cumsum(length) - length
            open_ = np.zeros(len(data), bool)
            for a, n in zip(begin, length):
                open_[a : a + n - LENGTH + 1] = True
            at, low, high, core, around = finder(data, open_)
            of = np.searchsorted(begin, low, "right") - 1
            records = {
                "core": core,
                "around": around,
                "key": np.array([x[0] for x in group], np.int64)[of],
                "at": at - begin[of] + np.array([x[1] for x in group], np.int64)[of],
                "low": at - low,
                "high": at - high,
                "known": np.zeros(len(at), np.uint8),
            }
            # drawn by occurrence, so that a frequent core is drawn as often as it occurs
            place = records["key"].astype(np.uint64) * np.uint64(_BASE) + records["at"].astype(np.uint64)
            taken = at[_mixed(core ^ _mixed(place)) < limit]
            return records, [data[a : a + CORE].tobytes() for a in taken]

        def merged() -> dict[str, np.ndarray]:
            return {f: np.concatenate([h[f] for h in held]) for f, _ in FIELDS}

        group, size = [], 0
        for batch in batches:
            for segment in segments(batch, sizes.slice):
                group.append(segment)
                size += len(segment[2])
                if size >= sizes.slice:
                    records, sample = scanned(group)
                    yield found_rows(np.arange(len(sample)) % parts, SAMPLED, np.zeros(len(sample)), sample)
                    held.append(records)
                    n_held += len(records["at"])
                    group, size = [], 0
                    if n_held >= sizes.records:
                        yield from settled(merged())
                        held, n_held = [], 0
        if group:
            records, sample = scanned(group)
            yield found_rows(np.arange(len(sample)) % parts, SAMPLED, np.zeros(len(sample)), sample)
            held.append(records)
        if held and sum(len(h["at"]) for h in held):
            yield from settled(merged())

    return keyed.select("key", "text").mapInArrow(run, FOUND)


def settle_records(found: DataFrame, parts: int) -> DataFrame:
    """Compare records of the same core from all tasks: (kind, key, data)."""

    def judged(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        columns = {name: [] for name, _ in FIELDS}
        for blob in blobs:
            n, start = len(blob) // RECORD_BYTES, 0
            for name, t in FIELDS:
                columns[name].append(np.frombuffer(blob, t, n, start))
                start += n * np.dtype(t).itemsize
        records = {
            name: np.concatenate(c).astype(np.int64 if name in ("at", "low", "high") else c[0].dtype)
            for name, c in columns.items()
        }
        order, new_core, new_class = classed(records)
        records = _picked(records, order)
        core_of, class_of = np.cumsum(new_core) - 1, np.cumsum(new_class) - 1
        known = records["known"] > 0
        several = np.bincount(core_of, weights=new_class) > 1
        several |= np.bincount(core_of, weights=known) > 0
        repeat = _picked(records, ~new_class & ~known)
        yield by_key(REMOVED, repeat["key"], windows_of(repeat), parts)
        compare = _picked(records, new_class & several[core_of] & ~known)
        yield by_key(COMPARE, compare["key"], anchors_of(compare), parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blobs = None, []
        for batch in batches:
            own = batch.column("part").to_numpy()
            kinds = batch.column("kind").to_numpy()
            data = batch.column("data")
            passed = np.flatnonzero(kinds != RECORD)
            if len(passed):
                yield batch.take(pa.array(passed))
            for i in np.flatnonzero(kinds == RECORD):
                if own[i] != part and blobs:
                    yield from judged(blobs)
                    blobs = []
                part = own[i]
                blobs.append(data[i].as_py())
        if blobs:
            yield from judged(blobs)

    dealt = found.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, FOUND).select("kind", "key", "data")


class Splitters:
    """Ranges of cores; a core that fills several ranges is dealt over several buckets."""

    def __init__(self, sample: list[bytes], buckets: int):
        ordered = sorted(sample)
        picks = [ordered[len(ordered) * i // buckets] for i in range(1, buckets)] if ordered else []
        self.bounds = sorted(set(picks))
        self.hot = {core: picks.count(core) for core in self.bounds if picks.count(core) > 1}
        self.first_hot, at = {}, 2 * len(self.bounds) + 1
        for core in sorted(self.hot):
            self.first_hot[core] = at
            at += self.hot[core]

    def bucket(self, core: bytes, key: int, at: int) -> tuple[int, bool]:
        """(bucket, whether its core is spread over other buckets too)."""
        if core in self.hot:
            return self.first_hot[core] + (key * 31 + at) % self.hot[core], True
        low, high = 0, len(self.bounds)
        while low < high:
            mid = (low + high) // 2
            if self.bounds[mid] <= core:
                low = mid + 1
            else:
                high = mid
        return low, False


SUFFIXES = "bucket int, spread boolean, key long, at long, low int, high int, bytes binary"


def suffixes(keyed: DataFrame, compare: DataFrame, splitters: Splitters) -> DataFrame:
    """The bytes around each anchor that has to be compared, with its bucket."""
    wanted = compare.groupBy("key").agg(F.collect_list("data").alias("anchors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SUFFIXES.split(", ")]
        for batch in batches:
            for row in range(batch.num_rows):
                raw = batch.column("text")[row].as_py().encode()
                key = batch.column("key")[row].as_py()
                anchors = b"".join(batch.column("anchors")[row].as_py())
                rows = []
                for at, low, high in np.frombuffer(anchors, "<i8").reshape(-1, 3).tolist():
                    bucket, spread = splitters.bucket(raw[at : at + CORE], key, at)
                    around = raw[at - low : at - high + LENGTH]
                    rows.append((bucket, spread, key, at, low, high, around))
                for start in range(0, len(rows), 50_000):
                    part = zip(*rows[start : start + 50_000])
                    types = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(part, types)], names=names
                    )

    joined = keyed.join(wanted, "key").select("key", "text", "anchors")
    return joined.mapInArrow(run, SUFFIXES)


def multikey_order(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of tokens by multikey quicksort: (order, common tokens with the row before).

    All runs of rows that agree so far are partitioned by their next token at once; runs of one
    row are finished. Ties keep their order.
    """
    n, width = tokens.shape
    order, same = np.arange(n), np.zeros(n, np.int64)
    slots = np.arange(n)  # places in `order` that belong to unfinished runs
    run = np.zeros(n, np.int64)
    for depth in range(width):
        if not len(slots):
            break
        rows = order[slots]
        moved = np.lexsort([tokens[rows, depth], run])
        rows = order[slots] = rows[moved]
        value, run = tokens[rows, depth], run[moved]
        equal = np.append(False, (run[1:] == run[:-1]) & (value[1:] == value[:-1]))
        same[slots[equal]] = depth + 1
        # runs split at new values; runs of one row leave
        run = np.cumsum(~equal)
        alive = np.bincount(run)[run] > 1
        slots, run = slots[alive], run[alive]
    return order, same


def common_bytes(tokens: np.ndarray, order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Bytes that each row, in sorted order, shares with the row before it."""
    width = tokens.shape[1]
    out = same * 8
    inside = np.flatnonzero(same < width)
    inside = inside[inside > 0]
    differ = tokens[order[inside], same[inside]] ^ tokens[order[inside - 1], same[inside]]
    octets = differ.astype(">u8").view(np.uint8).reshape(-1, 8)
    out[inside] += np.argmax(octets != 0, axis=1)
    if len(out):
        out[0] = 0
    return out


def as_tokens(rows: list[bytes], width: int) -> np.ndarray:
    """Big-endian eight-byte tokens, padded with zeros: they sort as the bytes do."""
    size = -(-width // 8) * 8
    flat = np.frombuffer(b"".join(r.ljust(size, b"\0") for r in rows), ">u8")
    return flat.astype(np.uint64).reshape(len(rows), size // 8)


def repeated_windows(low: np.ndarray, high: np.ndarray, around: list[bytes]):
    """Pairs (row, distance of the window from the anchor) that repeat an earlier row's window.

    Rows come in the order of their places. A row answers for the windows that start ``low`` to
    ``high`` bytes before its anchor.
    """
    n = len(low)
    after = as_tokens([b[s:] for b, s in zip(around, low.tolist())], LENGTH)
    before = as_tokens([b[:s][::-1] for b, s in zip(around, low.tolist())], REACH)
    places, ranks = np.arange(n), []
    for tokens in (after, before):
        order, same = multikey_order(tokens)
        rank = np.empty(n, np.int64)
        rank[order] = places
        ranks.append((rank, common_bytes(tokens, order, same)))
    (rank_after, common_after), (rank_before, common_before) = ranks
    out_row, out_distance = [], []
    for distance in range(int(high.min(initial=REACH)), int(low.max(initial=-1)) + 1):
        rows = np.flatnonzero((high <= distance) & (distance <= low))
        if len(rows) < 2:
            continue
        # a class is named by the first sorted row of its run
        right = np.maximum.accumulate(np.where(common_after < LENGTH - distance, places, 0))
        left = np.maximum.accumulate(np.where(common_before < distance, places, 0))
        name = right[rank_after[rows]] * n + left[rank_before[rows]]
        order = np.argsort(name, kind="stable")
        again = np.append(False, name[order[1:]] == name[order[:-1]])
        rows = rows[order[again]]
        out_row.append(rows)
        out_distance.append(np.full(len(rows), distance))
    empty = [np.empty(0, np.int64)]
    return np.concatenate(out_row + empty), np.concatenate(out_distance + empty)


def runs_of(keys, at, rows, distances) -> tuple[np.ndarray, np.ndarray]:
    """(keys, (first window, number of windows)) of windows given by row and distance."""
    order = np.lexsort([-distances, rows])
    rows, start = rows[order], (at[rows[order]] - distances[order])
    new = np.append(True, (rows[1:] != rows[:-1]) | (np.diff(start) != 1)) if len(rows) else []
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(rows)))
    return keys[rows[first]], packed(start[first], count)


SORTED = "kind int, key long, data binary, start long"
WINDOW = 4  # kind of rows that hold one window's bytes


def sort_buckets(dealt: DataFrame, buckets: int) -> DataFrame:
    """Repeats within each bucket, and the first windows of cores that other buckets share."""

    def judged(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.sort_by([("key", "ascending"), ("at", "ascending")])
        keys, at = rows["key"].to_numpy(), rows["at"].to_numpy()
        low = rows["low"].to_numpy().astype(np.int64)
        high = rows["high"].to_numpy().astype(np.int64)
        around = rows["bytes"].to_pylist()
        row, distance = repeated_windows(low, high, around)
        own, ranges = runs_of(keys, at, row, distance)
        done = by_key(REMOVED, own, ranges, 1).drop_columns(["part"])
        yield done.append_column("start", pa.nulls(done.num_rows, pa.int64()))
        if not rows["spread"][0].as_py():
            return
        gone = set(zip(row.tolist(), distance.tolist()))
        for i, b in enumerate(around):
            left = [d for d in range(high[i], low[i] + 1) if (i, d) not in gone]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([WINDOW] * len(left), pa.int32()),
                    pa.array([int(keys[i])] * len(left), pa.int64()),
                    pa.array([b[low[i] - d : low[i] - d + LENGTH] for d in left], pa.binary()),
                    pa.array([int(at[i]) - d for d in left], pa.int64()),
                ],
                names=["kind", "key", "data", "start"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            own = batch.column("bucket").to_numpy()
            cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
            for a, b in zip(cuts, np.append(cuts[1:], len(own))):
                if own[a] != bucket and held:
                    yield from judged(pa.Table.from_batches(held))
                    held = []
                bucket = own[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from judged(pa.Table.from_batches(held))

    placed = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(run, SORTED)


def across_boundaries(windows: DataFrame) -> DataFrame:
    """Windows that were first in their bucket and come later than another bucket's first one.

    A window has one row a bucket at most, so no group is large.
    """
    place = Window.partitionBy("data").orderBy("key", "start")
    later = windows.withColumn("n", F.row_number().over(place)).filter("n > 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = batch.column("start").to_numpy()
            ranges = packed(start, np.ones(len(start)))
            data = pa.array([r.tobytes() for r in ranges], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), data], names=["key", "data"])

    return later.select("key", "start").mapInArrow(run, "key long, data binary")


def with_keys(docs: DataFrame, carried: bool = False) -> DataFrame:
    """(key, doc_id, text) with unique keys in the order of documents; ``carried`` adds the row's
    other columns as a struct."""
    base = texts(docs)
    if carried:
        others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
        base = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.struct(*others).alias("carried"),
        )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    odd = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        return base.withColumn("key", F.col("doc_id"))
    # rows that share an id, or have none, get keys that follow the sorted rows
    placed = base.repartitionByRange(F.col("doc_id").asc_nulls_first(), "text")
    placed = placed.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return written(placed.withColumn("key", F.monotonically_increasing_id()), "keyed-documents")


def spans_of(ranges: bytes, n_bytes: int) -> np.ndarray:
    """Maximal removed runs (start, end) from ranges of window starts."""
    rows = np.frombuffer(ranges, "<i8").reshape(-1, 2)
    if not len(rows):
        return rows
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    ends = np.maximum.accumulate(rows.sum(axis=1) + LENGTH - 1)
    new = np.append(True, rows[1:, 0] > ends[:-1])
    return np.stack([rows[new, 0], ends[np.append(np.flatnonzero(new)[1:], len(rows)) - 1]], axis=1)


def removed_windows(keyed: DataFrame, total: int, sizes: Sizes) -> DataFrame:
    """(key, data): ranges of the windows that repeat an earlier one; ``total`` bytes of text."""
    spark = keyed.sparkSession
    files = task_count(spark, total, sizes.bucket_bytes)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // sizes.bucket_bytes))
    expected = max(1.0, total * 2 / (REACH + 1))
    found = written(
        settle_records(find_anchors(keyed, parts, sizes.sample / expected, sizes), parts),
        "suffix-records",
        files,
    )
    # the share above bounds the sample at any size; the limit guards against a repeated core
    sample = found.filter(F.col("kind") == SAMPLED).limit(4 * sizes.sample).select("data").collect()
    splitters = Splitters([bytes(r.data) for r in sample], parts)
    compare = found.filter(F.col("kind") == COMPARE).select("key", "data")
    resolved = written(
        sort_buckets(suffixes(keyed, compare, splitters), parts), "suffix-repeats", files
    )
    spread = across_boundaries(
        resolved.filter(F.col("kind") == WINDOW).select("key", "data", "start")
    )
    repeats = found.filter(F.col("kind") == REMOVED).select("key", "data")
    own = resolved.filter(F.col("kind") == REMOVED).select("key", "data")
    return repeats.unionByName(own).unionByName(spread)


OUTPUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _with_ranges(keyed: DataFrame, sizes: Sizes) -> DataFrame:
    total = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = removed_windows(keyed, total, sizes)
    ranges = ranges.groupBy("key").agg(F.collect_list("data").alias("ranges"))
    files = task_count(keyed.sparkSession, total, sizes.bucket_bytes)
    return keyed.join(ranges, "key", "left").drop("key").coalesce(files)


def _cut(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes, int]]:
    """(text, what is left of it, removed runs) of each row."""
    for text, ranges in zip(batch.column("text"), batch.column("ranges")):
        raw = text.as_py().encode()
        spans = spans_of(b"".join(ranges.as_py() or []), len(raw))
        edges = [0, *spans.ravel().tolist(), len(raw)]
        yield raw, b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])), len(spans)


def suffix_dedup(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())
                for raw, kept, spans in _cut(batch)
            ]
            columns = list(zip(*rows)) or [()] * 4
            numbers = [pa.array(c, pa.int64()) for c in columns[:3]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *numbers, pa.array(columns[3], pa.string())],
                names=[x.split()[0] for x in OUTPUT.split(", ")],
            )

    return _with_ranges(with_keys(docs), sizes).mapInArrow(run, OUTPUT)


def kept_documents(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """The input's rows with what is left of their texts, n_chars counted anew.

    Of a character that was cut in two nothing is left; a document goes if all of it was removed.
    """
    joined = _with_ranges(with_keys(docs, carried=True), sizes)
    carried = joined.schema["carried"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k.decode(errors="ignore"), bool(k or not r)) for r, k, _ in _cut(batch)]
            left = batch.append_column("kept", pa.array([t for t, _ in rows], pa.string()))
            stays = pa.array([s for _, s in rows], pa.bool_())
            yield left.filter(stays).select(["kept", "carried"])

    kept = joined.mapInArrow(run, f"kept string, carried {carried}")
    columns = {c: F.col(f"carried.`{c}`") for c in docs.columns if c != "text"}
    columns["text"] = F.col("kept")
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return kept.select(*(columns[c].alias(c) for c in docs.columns))
