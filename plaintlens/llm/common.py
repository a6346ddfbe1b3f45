"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens.session import scratch_path

#: Bytes of text that a Python task handles at once; longer texts are handled alone.
SLICE_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null text as empty; every other column is left behind."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def byte_slices(
    batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of at most ``rows`` rows and ``limit`` bytes in ``column``."""
    lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        stop = stop if rows is None else min(stop, start + rows)
        yield batch.slice(start, stop - start)
        start = stop


def map_texts(
    docs: DataFrame, make: Callable[[], Callable[[list[int], list[str]], dict]], schema: str
) -> DataFrame:
    """Narrow map over (doc_id, text): ``make()`` runs once a task and returns a function of
    (ids, texts) that gives columns, doc_id added. No shuffle; memory follows one slice."""
    fields = [part.strip().split(" ", 1)[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in byte_slices(batch, "text"):
                columns = work(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                columns.setdefault("doc_id", part.column("doc_id"))
                yield pa.RecordBatch.from_pydict({name: columns[name] for name in fields})

    return docs.mapInArrow(run, schema)


@contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Plans run inside send at most about ``limit`` bytes to a Python worker at once (a longer row
    alone)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, str(limit))
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def task_count(spark: SparkSession, amount: int, each: int) -> int:
    """Tasks, and so files, for ``amount`` of rows or bytes: one for ``each``, four a core at least.

    Follows the data, where ``spark.sql.shuffle.partitions`` may be set far higher: each file that
    is made costs requests, and on a local file system Hadoop starts three processes for it.
    """
    return max(4 * spark.sparkContext.defaultParallelism, -(-amount // each))


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the folder that all executors share: cuts the lineage, so a
    lost executor repeats its own tasks only, and columns are read back as needed. With ``files``,
    neighbouring partitions are written by one task, so that there are no more files than that."""
    path = scratch_path(df.sparkSession, name)
    df = df if files is None else df.coalesce(files)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
