"""SimHash near-duplicates by generalised pigeonhole.

Fingerprints are reduced to different ones first. Bits that vary together are grouped into
partitions. If partition i may differ in t_i bits and the sum of the t_i is T - m + 1 for m
partitions, two fingerprints at distance T or less meet the threshold of at least one. Dynamic
programming picks m and the t_i with the fewest estimated rows and candidates. A fingerprint is put
into one bucket for each way to blank t_i bits of partition i; members of a bucket agree in all
bits that its mask keeps. Buckets over a size are split by the same principle on the bits that
their mask leaves out, until all are small. Candidates are verified; a bucket hands on a spanning
forest of its links, never all pairs. Components of those links give the result.

Defined cases: null or wordless text has fingerprint zero and links like any other; copies have the
same fingerprint; repeated rows each get a row; a null doc_id keeps its fingerprint and gets the
smallest doc_id of its component, null if there is none; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import map_texts, task_count, texts, written
from plaintlens.llm.components import connected_components

BITS = 64
#: Members of a bucket beyond which it is split.
BUCKET = 1_000
#: Fingerprints for which an intermediate table gets a file.
FILE_ROWS = 500_000

#: Byte -> its eight bits in eight byte-wide lanes.
_OCTETS = np.arange(256, dtype=np.uint8)[:, None]
_LANES = np.unpackbits(_OCTETS, axis=1, bitorder="little").view(np.uint64).ravel()


def shingles(text: str, k: int) -> list[bytes]:
    words = text.encode().lower().split()  # A-Z only, ASCII white space only
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends + 1 - sizes
    pairs = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return [joined[a:b] for a, b in pairs]


def fingerprints_of(batch: list[str], k: int) -> np.ndarray:
    """Unsigned 64-bit fingerprints: a bit is set if it is set in over half the hashes."""
    hash64 = xxhash.xxh64_intdigest
    lists = [[hash64(s, 42) for s in shingles(text, k)] for text in batch]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    counts = np.zeros((len(lists), BITS), np.int64)
    if sizes.sum():
        hashes = np.fromiter((h for one in lists for h in one), np.uint64, int(sizes.sum()))
        filled = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[filled]
        # sums of 255 rows at most fit into a byte-wide lane
        cuts = [np.arange(a, a + n, 255) for a, n in zip(starts, sizes[filled])]
        parts = np.cumsum([len(c) for c in cuts]) - [len(c) for c in cuts]
        cuts = np.concatenate(cuts)
        octets = hashes.view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            lanes = np.add.reduceat(_LANES[octets[:, byte]], cuts)
            wide = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
            counts[filled, 8 * byte : 8 * byte + 8] = np.add.reduceat(wide, parts, axis=0)
    ones = 2 * counts > sizes[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, fp): a narrow map over whole texts."""

    def make():
        return lambda _, batch: {"fp": fingerprints_of(batch, k).view(np.int64)}

    return map_texts(texts(docs), make, "doc_id long, fp long")


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """(rows, 64 x 64 matrix of how often two bits are both set), over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, rows = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            own = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint8)
            bits = np.unpackbits(own, bitorder="little").reshape(-1, BITS).astype(np.float32)
            both += np.rint(bits.T @ bits).astype(np.int64)
            rows += len(bits)
        cells = np.append(both.ravel(), rows)
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(cells)), "n": cells})

    summed = prints.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell")
    cells = dict(summed.agg(F.sum("n").alias("n")).collect())  # 4,097 rows at any size
    flat = np.array([cells.get(i, 0) for i in range(BITS * BITS + 1)], np.int64)
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def grouped_bits(rows: int, both: np.ndarray, m: int) -> list[list[int]]:
    """Bits in ``m`` partitions of near-equal size, correlated ones together."""
    share = both / max(rows, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    tied = np.abs((share - np.outer(p, p)) / spread)
    np.fill_diagonal(tied, 0)
    left, parts = set(range(BITS)), []
    for i in range(m):
        size = (BITS - sum(map(len, parts))) // (m - i)
        free = sorted(left)
        part = [max(free, key=lambda b: (tied[b, free].max(), -b))]
        while len(part) < size:
            rest = sorted(left - set(part))
            part.append(max(rest, key=lambda b: (tied[b, part].sum(), -b)))
        left -= set(part)
        parts.append(sorted(part))
    return parts


def estimated_cost(rows: int, agree: np.ndarray, t: int) -> float:
    """Bucket rows and expected candidate pairs of a partition with threshold ``t``.

    ``agree`` has each bit's chance to be equal in two fingerprints. Summed over all ways to blank
    t bits, the chance to agree in the others is a coefficient of the product of (agree + x).
    """
    if t < 0:
        return 0.0
    chance = reduce(lambda poly, a: np.convolve(poly, [a, 1.0]), agree, np.array([1.0]))
    ways = reduce(lambda poly, _: np.convolve(poly, [1.0, 1.0]), agree, np.array([1.0]))
    return rows * ways[t] + 0.1 * rows * rows / 2 * chance[t]


def allocation(
    rows: int, both: np.ndarray, distance: int
) -> tuple[list[list[int]], list[int]]:
    """(partitions of bits, threshold of each); a threshold of -1 leaves a partition out.

    Without a row nothing is linked and no mask is needed (every plan would cost nothing)."""
    if rows == 0:
        return [], []
    p = np.diag(both) / max(rows, 1)
    agree = p * p + (1 - p) * (1 - p)
    best = None
    for m in range(1, distance + 2):
        parts, total = grouped_bits(rows, both, m), distance - m + 1
        # cost of the first i partitions with thresholds that sum to s
        plans = {0: (0.0, [])}
        for i, part in enumerate(parts):
            grown: dict[int, tuple[float, list[int]]] = {}
            for s, (cost, chosen) in plans.items():
                for t in range(-1, min(distance, len(part)) + 1):
                    new = cost + estimated_cost(rows, agree[part], t)
                    if s + t not in grown or new < grown[s + t][0]:
                        grown[s + t] = (new, [*chosen, t])
            plans = grown
        if best is None or plans[total][0] < best[0]:
            best = (plans[total][0], parts, plans[total][1])
    return best[1], best[2]


def masks_of(parts: list[list[int]], thresholds: list[int]) -> np.ndarray:
    """One mask for each way to blank t bits of a partition."""
    out = []
    for part, t in zip(parts, thresholds):
        if t >= 0:
            out += [sum(1 << b for b in part if b not in blank) for blank in combinations(part, t)]
    return np.array(out, np.uint64)


def finer_masks(mask: int, distance: int) -> list[int]:
    """``mask`` with one of distance + 1 blocks of the bits that it leaves out; none if too few."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    if len(free) <= distance:
        return []
    blocks = np.array_split(free, distance + 1)
    return [mask | sum(1 << int(b) for b in block) for block in blocks]


def in_buckets(prints: DataFrame, masks_for: Callable[[int], list[int]]) -> DataFrame:
    """(mask, value, fp) -> the rows' buckets under the masks that ``masks_for`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            own = batch.column("mask").to_numpy()
            for mask in np.unique(own):
                rows = fps[own == mask]
                for new in masks_for(int(mask) & (2**BITS - 1)):
                    fixed = np.array([new], np.uint64).view(np.int64)[0]
                    yield pa.RecordBatch.from_pydict(
                        {"mask": np.full(len(rows), fixed), "value": rows & fixed, "fp": rows}
                    )

    return prints.select("mask", "fp").mapInArrow(run, "mask long, value long, fp long")


def small_buckets(prints: DataFrame, masks: np.ndarray, distance: int) -> DataFrame:
    """Bucket rows, every bucket over ``BUCKET`` members split until none is."""
    start = [int(m) for m in masks]
    rows = in_buckets(prints.withColumn("mask", F.lit(0).cast("long")), lambda _: start)
    done = []
    while True:
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        # a mask with too few free bits cannot be refined and cannot be large: prints are different
        hot = written(sizes.filter(F.col("n") > BUCKET).select("mask", "value"), "hot-buckets")
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows])
        done.append(rows.join(hot, ["mask", "value"], "left_anti"))
        split = in_buckets(
            rows.join(hot, ["mask", "value"], "left_semi"),
            lambda mask: finer_masks(mask, distance),
        )
        rows = written(split.distinct(), "split-buckets")


def near_rows(mask: np.ndarray, value: np.ndarray, fp: np.ndarray, distance: int):
    """Positions (a, b) of all pairs within ``distance`` inside each bucket; rows come sorted by
    bucket."""
    n = len(fp)
    new = np.append(True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
    first = np.flatnonzero(new)
    end = np.append(first[1:], n)[np.cumsum(new) - 1]
    found_a, found_b = [], []
    at, step = np.arange(n), 1
    while len(at):
        at = at[at + step < end[at]]
        near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= distance]
        found_a.append(near)
        found_b.append(near + step)
        step += 1
    return np.concatenate([*found_a, []]).astype(int), np.concatenate([*found_b, []]).astype(int)


def near_pairs(mask: np.ndarray, value: np.ndarray, fp: np.ndarray, distance: int):
    """All pairs (fp, fp) within ``distance`` inside each bucket, the smaller number first."""
    a, b = near_rows(mask, value, fp, distance)
    return np.minimum(fp[a], fp[b]), np.maximum(fp[a], fp[b])


def forest(mask: np.ndarray, value: np.ndarray, fp: np.ndarray, distance: int):
    """Links (fp, fp) that connect what is within ``distance`` inside each bucket.

    Rows come sorted by bucket. At most one link a row.
    """
    a, b = near_rows(mask, value, fp, distance)
    label = np.arange(len(fp))
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label[a] == label[b]).all():
            break
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b): links that connect what is within ``distance`` among different fingerprints."""
    rows, both = bit_statistics(prints)
    masks = masks_of(*allocation(rows, both, distance))
    return linked(small_buckets(prints, masks, distance), distance, forest)


def all_pairs(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b): every pair within ``distance`` among different fingerprints, once. Buckets stay
    whole: at wide distances splitting multiplies the rows more than it saves comparisons."""
    rows, both = bit_statistics(prints)
    masks = [int(m) for m in masks_of(*allocation(rows, both, distance))]
    zero = prints.withColumn("mask", F.lit(0).cast("long"))
    return linked(in_buckets(zero, lambda _: masks), distance, near_pairs).distinct()


def linked(buckets: DataFrame, distance: int, find: Callable) -> DataFrame:
    """(a, b): what ``find`` gives for the whole buckets of each task."""
    dealt = buckets.repartition("mask", "value").sortWithinPartitions("mask", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3  # the rows of a bucket that may go on

        def emit(columns):
            mask, value, fp = columns
            a, b = find(mask, value, fp.view(np.uint64), distance)
            return pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            own = [batch.column(c).to_numpy() for c in ("mask", "value", "fp")]
            columns = [np.concatenate([x, y]) for x, y in zip(held, own)]
            mask, value, _ = columns
            if not len(mask):
                continue
            last = int(np.flatnonzero((mask != mask[-1]) | (value != value[-1])).max(initial=-1)) + 1
            held = [x[last:] for x in columns]
            if last:
                yield emit([x[:last] for x in columns])
        if len(held[0]):
            yield emit(held)

    return dealt.mapInArrow(run, "a long, b long")


def simhash_components(docs: DataFrame, k: int = 3, distance: int = 3) -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id."""
    prints = written(fingerprints(docs, k), "fingerprints")
    files = task_count(docs.sparkSession, prints.count(), FILE_ROWS)
    different = written(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "different-fingerprints", files
    )
    roots = connected_components(links(different, distance), files)
    rooted = different.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(rooted.join(smallest, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
