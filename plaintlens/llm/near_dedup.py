"""Near-duplicate texts of the pipeline: SimHash candidates, verified by exact Jaccard similarity.

Two texts are near duplicates when their sets of five-word shingles have a Jaccard similarity of
0.8 or more. Candidates are pairs whose fingerprints over the same shingles differ in at most 14
bits, found by the buckets of ``simhash``. At similarity 0.8 two bits differ with chance 0.15, so
14 of 64 bits cover 94.7 % of pairs right at the bar, more above it. Lengths and parities sort out
most candidates without loss; the rest is compared shingle by shingle before it links.

Defined cases: texts with equal sets of shingles are one node; texts without words are near
duplicates of one another only; a text of one to five words is one shingle. Shingles count as
equal when their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import map_texts, written
from plaintlens.llm.components import connected_components
from plaintlens.llm.simhash import all_pairs, fingerprints_of, shingles

WORDS, DISTANCE = 5, 14
#: Similarity from which texts are near duplicates, as a fraction.
SHARED, OF = 4, 5
PARITIES = 1_024


def text_id() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def shingle_set(text: str) -> np.ndarray:
    """Sorted different hashes of the shingles."""
    hashed = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, WORDS)]
    return np.unique(np.array(hashed, np.uint64))


def parities(hashes: np.ndarray) -> bytes:
    """Of each of 1,024 slots, whether an odd number of shingles falls into it. Every slot in which
    two sets differ holds a shingle that only one of them has."""
    counts = np.bincount((hashes >> np.uint64(54)).astype(np.int64), minlength=PARITIES)
    return np.packbits(counts.astype(np.uint8) & 1).tobytes()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= SHARED * (len(a) + len(b) - both)


def described(docs: DataFrame) -> DataFrame:
    """(doc_id: id of the text, node: id of its set, fp, n shingles, odd): a narrow map."""

    def work(_, batch: list[str]) -> dict:
        sets = [shingle_set(t) for t in batch]
        return {
            "node": np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64),
            "fp": fingerprints_of(batch, WORDS).view(np.int64),
            "n": np.array([len(s) for s in sets], np.int64),
            "odd": pa.array([parities(s) for s in sets], pa.binary()),
        }

    rows = docs.select(text_id().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_texts(rows, lambda: work, "doc_id long, node long, fp long, n long, odd binary")


def candidates(nodes: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes that fingerprint, size and parities let be near duplicates."""
    prints = written(nodes.select("fp").distinct(), "near-fingerprints")
    pairs = all_pairs(prints, DISTANCE).union(
        nodes.groupBy("fp").count().filter("count > 1").select("fp", F.col("fp").alias("b"))
    )
    of = lambda x: nodes.select(F.col("fp").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("node", "n", "odd")))
    joined = written(pairs, "near-pairs").join(of("a"), "a").join(of("b"), "b")
    joined = joined.filter(
        (F.col("a") != F.col("b")) | (F.col("a_node") < F.col("b_node"))
    ).filter(OF * F.least("a_n", "b_n") >= SHARED * F.greatest("a_n", "b_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                for c in ("a_odd", "b_odd")
            )
            apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
            n = batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy()
            # similarity s: at most (1 - s) / (1 + s) of both sizes lies in one set only
            keep = pa.array((OF + SHARED) * apart <= (OF - SHARED) * n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a_node").filter(keep), batch.column("b_node").filter(keep)], names=["a", "b"]
            )

    return joined.select("a_node", "a_n", "a_odd", "b_node", "b_n", "b_odd").mapInArrow(run, "a long, b long")


def verified(docs: DataFrame, first: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of nodes with enough shingles in common; ``first`` has (node, doc_id) of a text."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    ids = written(first.join(wanted, "node"), "near-texts")
    rows = docs.select(text_id().alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(ids.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])

    def work(_, batch: list[str]) -> dict:
        return {"shingles": pa.array([shingle_set(t).tobytes() for t in batch], pa.binary())}

    sets = map_texts(rows, lambda: work, "doc_id long, shingles binary").join(ids, "doc_id")
    sets = written(sets.select("node", "shingles"), "near-sets")
    of = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"{x}_set"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("a_set"), batch.column("b_set"))
            same = [similar(*(np.frombuffer(x.as_py(), np.uint64) for x in two)) for two in sides]
            keep = pa.array(same, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"]
            )

    joined = pairs.join(of("a"), "a").join(of("b"), "b")
    return joined.select("a", "b", "a_set", "b_set").mapInArrow(run, "a long, b long")


def near_components(docs: DataFrame) -> DataFrame:
    """(text_id, root), once for each different text: equal roots are near duplicates."""
    texts = written(described(docs), "near-described")
    first = written(
        texts.groupBy("node").agg(*(F.first(c).alias(c) for c in ("fp", "n", "odd")), F.min("doc_id").alias("doc_id")),
        "near-nodes",
    )
    nodes = first.filter("n > 0")
    pairs = written(candidates(nodes), "near-candidates")
    roots = connected_components(verified(docs, first.select("node", "doc_id"), pairs))
    return (
        texts.select(F.col("doc_id").alias("text_id"), "node").distinct()
        .join(roots, "node", "left")
        .select("text_id", F.coalesce("root", "node").alias("root"))
    )
