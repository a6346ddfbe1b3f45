"""Exact k-nearest search of a table of question vectors over a table of stored vectors.

A question must be compared with every stored vector it may match, but the pairs need not exist
as rows. Each task multiplies its Arrow batches with the question matrix and keeps, per
question, only the best ``k`` seen so far; a task emits at most ``questions * k`` rows, and the
final ranking shuffles just those.

Questions within ``max_question_bytes`` travel to the tasks as one matrix, and the store is scanned
once, without a shuffle and without copies. More questions never reach the driver: they and the
stored vectors are packed into blocks of bounded bytes, and each pair of blocks meets once in a task.
The work of that is questions times vectors by nature; memory is bounded by the blocks of a task.

Vectors are compared with those of the same length only; :func:`incomparable` names the questions
that no stored vector can answer. Distances are rounded to nine places before ranking; equal ones
go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens.session import written

MAX_QUESTION_BYTES = 32 * 1024 * 1024
_CELLS = 4_000_000

#: Bytes of one packed block, of the smallest one, and of one partition of blocks.
_BLOCK_BYTES = 4 * 1024 * 1024
_SMALL_BLOCK_BYTES = 64 * 1024
_PART_BYTES = 32 * 1024 * 1024

_PACKED = "block string, dim int, keys array<string>, tags array<string>, vectors binary"
_PACKED_ARROW = pa.schema(
    [
        ("block", pa.string()),
        ("dim", pa.int32()),
        ("keys", pa.list_(pa.string())),
        ("tags", pa.list_(pa.string())),
        ("vectors", pa.binary()),
    ]
)

_SCHEMA = "question_id string, id string, distance double"
_ARROW = pa.schema(
    [("question_id", pa.string()), ("id", pa.string()), ("distance", pa.float64())]
)


class _Best:
    """The k nearest (distance, id) pairs of each question over the vectors seen so far."""

    def __init__(self, ids: list[str], vectors: np.ndarray, categories: list[str], k: int):
        self.ids, self.vectors, self.k = ids, vectors.astype("float64"), k
        self.norms = (self.vectors**2).sum(axis=1)
        # categories are compared as codes; -1 asks for no category
        self.names = sorted({c for c in categories if c != ""})
        code = {name: i for i, name in enumerate(self.names)}
        self.categories = np.array([code.get(c, -1) for c in categories])
        self.best: list[list[tuple[float, str]]] = [[] for _ in ids]
        self.limit = np.full(len(ids), np.inf)

    def add(self, ids: pa.Array, vectors: np.ndarray, categories: pa.Array | None) -> None:
        codes = None
        if self.names:
            codes = pc.index_in(categories, value_set=pa.array(self.names))
            codes = pc.fill_null(codes, -2).to_numpy(zero_copy_only=False)
        rows = max(1, _CELLS // max(1, len(self.ids)))
        for at in range(0, len(ids), rows):
            part = slice(at, at + rows)
            self._add(ids[part], vectors[part], None if codes is None else codes[part])

    def _add(self, ids: pa.Array, vectors: np.ndarray, codes: np.ndarray | None) -> None:
        vectors = vectors.astype("float64")
        distance = self.norms[:, None] + (vectors**2).sum(axis=1) - 2 * (self.vectors @ vectors.T)
        distance = np.round(np.maximum(distance, 0.0), 9)
        near = distance <= self.limit[:, None]
        if codes is not None:
            near &= (self.categories[:, None] == -1) | (self.categories[:, None] == codes[None, :])
        for q in np.flatnonzero(near.any(axis=1)):
            found = np.flatnonzero(near[q])
            if len(found) > self.k:
                kth = np.partition(distance[q, found], self.k - 1)[self.k - 1]
                found = found[distance[q, found] <= kth]
            # ids become Python texts for these few rows only
            names = ids.take(pa.array(found)).to_pylist()
            merged = self.best[q] + list(zip(distance[q, found].tolist(), names))
            merged.sort()
            self.best[q] = merged[: self.k]
            if len(merged) >= self.k:
                self.limit[q] = self.best[q][-1][0]

    def rows(self) -> pa.RecordBatch:
        flat = [(q, i, d) for q, pairs in zip(self.ids, self.best) for d, i in pairs]
        columns = list(zip(*flat)) if flat else [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
        )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim)


def _scan(rows, store: DataFrame, k: int) -> DataFrame:
    """The best of every task for one block of questions."""
    blocks = {}
    for length in {len(r["embedding"]) for r in rows}:
        own = [r for r in rows if len(r["embedding"]) == length]
        vectors = np.array([r["embedding"] for r in own], dtype="float64")
        blocks[length] = (
            [r["question_id"] for r in own],
            vectors.reshape(len(own), length),
            [r["filter_category"] for r in own],
        )
    packed = store.sparkSession.sparkContext.broadcast(blocks)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {length: _Best(*block, k) for length, block in packed.value.items()}
        for batch in batches:
            lengths = pc.list_value_length(batch.column("embedding"))
            for length, own in best.items():
                same = batch.filter(pc.equal(lengths, length))
                if same.num_rows:
                    own.add(
                        same.column("id"),
                        _matrix(same.column("embedding"), length),
                        same.column("category"),
                    )
        for own in best.values():
            yield own.rows()

    return store.mapInArrow(scan, _SCHEMA)


def _packed(df: DataFrame, key: str, tag: str, limit: int) -> DataFrame:
    """Vectors of one length packed into rows of at most about ``limit`` bytes: block, dim, keys,
    tags, vectors (doubles one behind the other). Rows without a vector are left out."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[list, list, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            parts = held.pop(dim)
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "block": f"{task}-{made}",
                        "dim": dim,
                        "keys": [x for part in parts for x in part[0]],
                        "tags": [x for part in parts for x in part[1]],
                        "vectors": b"".join(part[2].tobytes() for part in parts),
                    }
                ],
                schema=_PACKED_ARROW,
            )

        for batch in batches:
            lengths = pc.list_value_length(batch.column("embedding"))
            for dim in pc.unique(lengths.drop_null()).to_pylist():
                same = batch.filter(pc.equal(lengths, dim))
                per = max(1, limit // max(1, 8 * dim))
                at = 0
                while at < same.num_rows:
                    room = per - sum(len(part[0]) for part in held.get(dim, []))
                    part = same.slice(at, room)
                    at += part.num_rows
                    vectors = _matrix(part.column("embedding"), dim).astype("float64")
                    held.setdefault(dim, []).append(
                        (part.column(key).to_pylist(), part.column(tag).to_pylist(), vectors)
                    )
                    if part.num_rows == room:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    return df.mapInArrow(pack, _PACKED)


def _block_pairs(questions: DataFrame, store: DataFrame, question_bytes: int, k: int) -> DataFrame:
    """The best of every task for questions of any number: no question reaches the driver.

    Questions and stored vectors are packed into blocks of bounded bytes, dealt to partitions of
    bounded bytes, and every pair of blocks meets once in the cross join of the partitions. A
    task keeps the best ``k`` of its own questions over the stored blocks it meets.
    """
    spark = store.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if questions.filter(F.col("filter_category") == "").isEmpty():
        # every question names a category: only those stored vectors are packed
        wanted = questions.select(F.col("filter_category").alias("category")).distinct()
        store = store.join(wanted, "category", "left_semi")
    store_bytes = 8 * store.agg(F.coalesce(F.sum(F.size("embedding")), F.lit(0)).alias("n")).first()["n"]
    # small sides still give every core a block of questions
    per_block = min(_BLOCK_BYTES, max(_SMALL_BLOCK_BYTES, question_bytes // (4 * cores)))
    asked = _packed(questions, "question_id", "filter_category", per_block)
    held = _packed(store, "id", "category", _BLOCK_BYTES)
    asked = asked.repartition(max(min(4 * cores, question_bytes // per_block + 1), -(-question_bytes // _PART_BYTES)))
    held = held.repartition(max(1, -(-store_bytes // _PART_BYTES)))
    pairs = asked.select(*[F.col(c).alias(f"q_{c}") for c in asked.columns]).join(
        held, F.col("q_dim") - F.col("dim") == 0
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, _Best] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                name, dim = batch.column("q_block")[at].as_py(), batch.column("dim")[at].as_py()
                if name not in best:
                    ids = batch.column("q_keys")[at].as_py()
                    best[name] = _Best(
                        ids, _vectors(batch.column("q_vectors")[at], len(ids), dim),
                        batch.column("q_tags")[at].as_py(), k,
                    )
                keys = batch.column("keys")[at].values
                best[name].add(
                    keys, _vectors(batch.column("vectors")[at], len(keys), dim), batch.column("tags")[at].values
                )
        for own in best.values():
            yield own.rows()

    return pairs.mapInArrow(search, _SCHEMA)


def _vectors(packed: pa.Scalar, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(packed.as_buffer(), "float64").reshape(rows, dim)


def incomparable(questions: DataFrame, store: DataFrame) -> DataFrame:
    """(question_id, reject_reason) of questions whose vector has a length that no stored one has.

    The lengths in the store are counted in one narrow pass; an empty store refuses nothing.
    """
    stored = store.groupBy(F.size("embedding").alias("_n")).agg(F.count(F.lit(1)).alias("_rows"))
    most = stored.orderBy(F.col("_rows").desc(), "_n").limit(5).collect()
    told = ", ".join(str(r["_n"]) for r in most)
    asked = questions.filter(F.lit(bool(most)))
    return asked.join(stored, F.size("embedding") == F.col("_n"), "left_anti").select(
        "question_id",
        F.concat(
            F.lit("Retrieval failed: the question's vector has "),
            F.size("embedding").cast("string"),
            F.lit(f" numbers, stored vectors have {told}."),
        ).alias("reject_reason"),
    )


def nearest(
    questions: DataFrame,
    store: DataFrame,
    k: int = K.TOP_K,
    category: str = "product_category",
    max_question_bytes: int = MAX_QUESTION_BYTES,
) -> DataFrame:
    """The ``k`` nearest stored vectors of each question: question_id, id, distance, rank.

    ``questions`` has question_id, embedding and optionally filter_category (null or "" searches
    everything); ``store`` has id, embedding and ``category``.
    """
    if "filter_category" not in questions.columns:
        questions = questions.withColumn("filter_category", F.lit(""))
    questions = questions.select(
        F.col("question_id").cast("string").alias("question_id"),
        F.coalesce("filter_category", F.lit("")).alias("filter_category"),
        "embedding",
    )
    if category not in store.columns:
        store = store.withColumn(category, F.lit(""))
    store = store.select(
        F.col("id").cast("string").alias("id"), "embedding", F.col(category).alias("category")
    )
    size = questions.agg(F.coalesce(F.sum(F.size("embedding")), F.lit(0)).alias("n")).first()["n"]
    order = W.partitionBy("question_id").orderBy("distance", "id")
    if size * 8 <= max_question_bytes:
        rows = questions.collect()  # bounded by max_question_bytes
        wanted = {r["filter_category"] for r in rows}
        if rows and "" not in wanted:
            # every question names a category: only those store partitions are read
            store = store.filter(F.col("category").isin(sorted(wanted)))
        found = _scan(rows, store, k)
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    found = written(_block_pairs(questions, store, size * 8, k), "nearest-found")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
