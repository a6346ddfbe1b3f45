"""Session helpers: the shared scratch folder, reliable checkpoints, scan spreading."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def build_session(cpus: int | str = 8, app: str = "plaintlens", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` when the session names one.

    A session on one machine (master ``local`` or ``local[...]``) may do without and uses its
    warehouse; anywhere else a missing setting is an error, because a machine-local folder would
    not survive the loss of an executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named or current:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named or current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{uuid.uuid4().hex}"
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"scratch-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application left in the shared folder; call it when its results are read.

    Frames that still read intermediate tables cannot be used afterwards.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark).rstrip('/')}/{_own_folder(spark)}"
    )
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once with a reliable checkpoint, so later steps never recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: later steps never recompute it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Exactly ``n`` rows of ``df`` (all, if it has fewer), no rows brought together in one task.

    Each task writes at most its first ``n`` rows, numbered; the tasks' row counts, summed in task
    order, tell how many of each belong to the result. The counts (one row a task) are all
    that meets in one place.
    """
    at, task = F.col("__first_at"), F.shiftright("__first_at", 33)
    within = at.bitwiseAND(F.lit((1 << 33) - 1))
    numbered = written(
        df.withColumn("__first_at", F.monotonically_increasing_id()).filter(within < n), "first-rows"
    )
    sizes = numbered.groupBy(task.alias("__first_task")).agg(F.count(F.lit(1)).alias("__first_n"))
    before = W.orderBy("__first_task").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        "__first_task", F.coalesce(F.sum("__first_n").over(before), F.lit(0)).alias("__first_start")
    )
    return (
        numbered.join(F.broadcast(starts), task == F.col("__first_task"))
        .filter(F.col("__first_start") + within < n)
        .drop("__first_at", "__first_task", "__first_start")
    )


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan of a few splits before costly narrow work.

    Only scans of less than eight splits (a gigabyte at the default split size) are dealt out, on a
    cluster of any size; all others pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, 8) else df


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after counting; beyond ``max_rows`` the join is left to AQE.

    Use on tables whose rows are narrow and cheap to count (checkpointed or stored).
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
