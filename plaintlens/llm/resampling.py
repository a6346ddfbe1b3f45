"""Importance resampling towards a target distribution over hashed word features.

Each text gives features: runs of ``lo`` to ``hi`` consecutive words joined by one space, repeats
counted; a feature's bucket is the unsigned crc32 of its UTF-8 bytes modulo ``BUCKETS``. Bucket
counts s (documents) and t (target) give every bucket a gain
floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))), B the bucket count; a document's weight is the floored
mean gain of its features (0 without one). The score adds Gumbel noise from a hash of the doc_id,
and the ``PERCENT`` per cent highest scores among documents of at least ``MIN_WORDS`` words are
drawn (ties to the smaller doc_id), which samples without replacement in proportion to exp(weight).

Method (batch concatenation): a task joins a batch's texts with a NUL sentinel (NUL inside a text
is a separator already, so it is made a space first), finds every word of the batch at once by
the kinds of its bytes, places each word in its document by ``searchsorted`` over the document
offsets, masks n-grams whose words lie in different documents, and counts buckets with
``bincount``. crc32 runs once a different feature of the batch.

Scale: two narrow passes over the texts (counts, then weights), between them one grouping of at
most ``BUCKETS`` rows a task; the gains (``BUCKETS`` numbers) go to the tasks in the closure. The
draw is a range-partitioned sort whose rows get their partition and place, written once; ranks
add the sizes of earlier partitions, one row a partition. No group, key or text meets one task
beyond its own document.

Defined cases: null, empty or wordless text: no features, weight 0, never drawn (fewer than
``MIN_WORDS`` words). Very long texts: handled alone in a slice, memory linear in their bytes.
A null doc_id hashes as "2024:" and sorts after all others among equal scores. Repeated rows
each give their own row; equal (score, doc_id) are ordered by their place in the input table, so
equal rows get consecutive ranks. Columns besides doc_id and text are ignored, whatever their
names. An empty documents table gives no rows; an empty target gives T = t = 0.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import byte_slices, written

# Fixed values of the contract: buckets, n-gram lengths, seed text, share drawn, least words.
BUCKETS = 10_000
NGRAMS = (1, 1)
SEED = "2024:"
PERCENT = 10
MIN_WORDS = 20
TWO_32 = 4294967296


def word_spans(texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, word starts, word ends, document of each word) of a batch, in one pass.

    Word bytes are 0-9, a-z and every byte of a non-ASCII character; A-Z are lower-cased first."""
    arr = pc.ascii_lower(pc.replace_substring(pa.array(texts, pa.large_string()).fill_null(""), "\x00", " "))
    buffer = "\x00".join(arr.to_pylist()).encode("utf-8")
    data = np.frombuffer(buffer, np.uint8)
    lengths = pc.binary_length(arr).to_numpy(zero_copy_only=False).astype(np.int64)
    doc_starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(lengths) else np.zeros(0, np.int64)
    word = ((data >= 0x30) & (data <= 0x39)) | ((data >= 0x61) & (data <= 0x7A)) | (data >= 0x80)
    edges = np.diff(np.concatenate(([False], word, [False])).astype(np.int8))
    starts = np.flatnonzero(edges == 1)
    ends = np.flatnonzero(edges == -1)
    docs = np.searchsorted(doc_starts, starts, side="right") - 1
    return buffer, starts, ends, docs


def features(texts: list[str | None], ngrams: tuple[int, int] = NGRAMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, document of each feature, words of each document)."""
    buffer, starts, ends, docs = word_spans(texts)
    n_words = np.bincount(docs, minlength=len(texts))
    buckets, owners = [], []
    for n in range(ngrams[0], ngrams[1] + 1):
        if len(starts) < n:
            continue
        first, last = starts[: len(starts) - n + 1], ends[n - 1 :]
        keep = docs[: len(docs) - n + 1] == docs[n - 1 :]  # the n words lie in one document
        first, last, owner = first[keep], last[keep], docs[: len(docs) - n + 1][keep]
        grams = [buffer[a:b] for a, b in zip(first.tolist(), last.tolist())]
        if n > 1:  # runs of words are joined by one space, whatever stood between them
            grams = [b" ".join(_words_of(g)) for g in grams]
        coded = pa.array(grams, pa.large_binary()).dictionary_encode()
        crc = np.fromiter((zlib.crc32(g) for g in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        buckets.append((crc % BUCKETS)[coded.indices.to_numpy()])
        owners.append(owner)
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n_words
    return np.concatenate(buckets), np.concatenate(owners), n_words


def _words_of(raw: bytes) -> list[bytes]:
    data = np.frombuffer(raw, np.uint8)
    word = ((data >= 0x30) & (data <= 0x39)) | ((data >= 0x61) & (data <= 0x7A)) | (data >= 0x80)
    edges = np.diff(np.concatenate(([False], word, [False])).astype(np.int8))
    return [raw[a:b] for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())]


def bucket_counts(table: DataFrame, ngrams: tuple[int, int] = NGRAMS) -> np.ndarray:
    """Feature count of every bucket over all texts of ``table`` (text column ``text``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text"):
                buckets, _, _ = features(part.column("text").to_pylist(), ngrams)
                total += np.bincount(buckets, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held.astype(np.int32), "n": total[held]})

    rows = (
        table.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(count, "bucket int, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most BUCKETS rows
    )
    counts = np.zeros(BUCKETS, np.int64)
    for row in rows:
        counts[row["bucket"]] = row["n"]
    return counts


def gains(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    S, T = float(s.sum()), float(t.sum())
    ratio = ((t + 1).astype(np.float64) * (S + BUCKETS)) / ((s + 1).astype(np.float64) * (T + BUCKETS))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def noise(doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000.0 * math.log(-math.log((h + 0.5) / TWO_32)))


def weights(docs: DataFrame, gain: np.ndarray, ngrams: tuple[int, int] = NGRAMS) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score (narrow, one pass)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                buckets, owners, n_words = features(part.column("text").to_pylist(), ngrams)
                n = len(n_words)
                n_features = np.bincount(owners, minlength=n)
                total = np.bincount(owners, weights=gain[buckets].astype(np.float64), minlength=n)
                # the sums are whole numbers far below 2**53: exact, then floored division
                weight = np.where(n_features > 0, np.floor_divide(total.astype(np.int64), np.maximum(n_features, 1)), 0)
                ids = part.column("doc_id").to_pylist()
                scores = weight + np.array([noise(i) for i in ids], np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "row": part.column("row"),
                        "n_words": n_words.astype(np.int64),
                        "n_features": n_features.astype(np.int64),
                        "weight": weight.astype(np.int64),
                        "score": scores,
                    }
                )

    return docs.mapInArrow(score, "doc_id long, row long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, ngrams: tuple[int, int] = NGRAMS, percent: int = PERCENT) -> DataFrame:
    """Every row of ``docs``: doc_id, n_features, weight, score, rank (null when not drawn)."""
    spark = docs.sparkSession
    # rows get a fixed place once, so a retried task cannot give them another
    rows = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "resample-rows",
    )
    gain = gains(bucket_counts(rows, ngrams), bucket_counts(target, ngrams))
    scored = written(weights(rows, gain, ngrams), "resample-scores")

    eligible = scored.where(F.col("n_words") >= MIN_WORDS)
    n = eligible.count()
    drawn = (n * percent) // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    placed = written(
        eligible.select("row", "score", "doc_id")
        .repartitionByRange(max(1, spark.sparkContext.defaultParallelism), *order)
        .sortWithinPartitions(*order)
        .select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "resample-order",
    )
    # the place in a partition is the low 33 bits of the increasing id
    placed = placed.withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    from pyspark.sql import Window

    before = sizes.select(
        "part", (F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before")
    ).fillna(0, ["before"])  # one row a partition
    ranks = (
        placed.join(F.broadcast(before), "part")
        .select("row", (F.col("before") + F.col("at") + 1).alias("rank"))
        .where(F.col("rank") <= drawn)
    )
    return scored.join(ranks, "row", "left").select(
        "doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank")
    )
