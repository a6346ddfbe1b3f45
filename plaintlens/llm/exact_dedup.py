"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own characters say so, so equal passages give equal chunks wherever they
stand. Every chunk gets an identifier (64-bit hash, rank among different chunks of that hash); the
ranks come from comparing the chunks' bytes, each different chunk moving once. Two documents are
equal when their ordered identifier lists are equal; only these short lists move from there on.

Defined cases: null text is empty; empty texts are equal to one another; a null doc_id counts as
smaller than any other; of rows with the same text and the same doc_id exactly one is kept; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import task_count, texts, written

#: A chunk has 512 characters at least, ends after a sentence end or one of these word ends, and
#: has 8,192 characters at most.
CHUNK_PATTERN = r"(?s).{510,8190}?[dghkpz.!?\n][ \n]|.{1,8192}"
#: Documents for which the table of groups gets a file.
FILE_ROWS = 100_000


def chunk_list(text: Column) -> Column:
    """The content-defined chunks; concatenated they are the text. Empty text: no chunk."""
    return F.regexp_extract_all(text, F.lit(CHUNK_PATTERN), F.lit(0))


def collided_chunks(chunks: DataFrame) -> DataFrame:
    """(hash, chunk, rank) of the chunks whose hash stands for more than one chunk."""
    distinct = chunks.groupBy("hash", "chunk").agg(F.count(F.lit(1)).alias("uses"))
    shared = distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bad = written(shared.select("hash"), "chunk-hashes")
    if bad.isEmpty():
        return None
    # the rank of a chunk is the number of smaller chunks of its hash
    rows = chunks.join(bad, "hash", "left_semi").groupBy("hash", "chunk").agg(
        F.count(F.lit(1)).alias("uses")
    )
    listed = rows.groupBy("hash").agg(F.sort_array(F.collect_list("chunk")).alias("all"))
    return listed.select("hash", F.posexplode("all").alias("rank", "chunk"))


def recipes(docs: DataFrame, chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, row, recipe, text_sha256): each row's ordered list of verified identifiers."""
    base = texts(docs).withColumn("row", F.monotonically_increasing_id())
    chunked = base.select("doc_id", "row", "text", chunk_list(F.col("text")).alias("chunks"))
    pieces = chunked.select("row", F.posexplode("chunks").alias("at", "chunk")).select(
        "row", "at", "chunk", chunk_hash(F.col("chunk")).cast("long").alias("hash")
    )
    plain = chunked.select(
        "doc_id",
        "row",
        F.transform(
            "chunks",
            lambda c: F.struct(chunk_hash(c).cast("long").alias("hash"), F.lit(0).alias("rank")),
        ).alias("recipe"),
        F.sha2("text", 256).alias("text_sha256"),
    )
    collided = collided_chunks(pieces.select("hash", "chunk"))
    if collided is None:
        return plain
    ranked = (
        pieces.join(collided, ["hash", "chunk"], "left")
        .groupBy("row")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("at", "hash", F.coalesce("rank", F.lit(0)).alias("rank"))
                )
            ).alias("listed")
        )
        .select("row", F.transform("listed", lambda x: F.struct(x.hash, x.rank)).alias("ids"))
    )
    return plain.join(ranked, "row", "left").select(
        "doc_id", "row", F.coalesce("ids", "recipe").alias("recipe"), "text_sha256"
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The input's rows, all columns as they are, without those that ``exact_dedup`` drops.

    A document is found again by its doc_id; of repeated rows of one doc_id and text one stays.
    """
    key = f"key_{uuid.uuid4().hex}"  # no column of the input has this name
    verdict = exact_dedup(docs).filter("kept").select(
        _row_key(F.col("text_sha256"), F.col("doc_id")).alias(key)
    )
    own = docs.withColumn(key, _row_key(F.sha2(F.coalesce("text", F.lit("")), 256), F.col("doc_id")))
    # one shuffle of the texts: the second step needs the rows as the join has dealt and sorted them
    return own.join(verdict, key, "left_semi").dropDuplicates([key]).drop(key)


def _row_key(sha: Column, doc_id: Column) -> Column:
    return F.concat_ws(":", sha, F.coalesce(doc_id.cast("long").cast("string"), F.lit("null")))


def exact_dedup(docs: DataFrame, chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Counts and kept rows come from a map-side aggregation over recipes. The join back puts one row
    per recipe against its documents, so a group holding a third of all rows can be split.
    """
    listed = written(recipes(docs, chunk_hash), "recipes")
    files = task_count(docs.sparkSession, listed.count(), FILE_ROWS)
    groups = listed.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    # written, so the join deals out both sides anew and can split the documents of a hot recipe
    return listed.join(written(groups, "recipe-groups", files), "recipe").select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )
