"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins and splits skewed
# partitions at run time; UTC keeps timestamp text stable; rows with long texts
# reach Python in batches of a few MB; a task lists many folders, not one.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

# Rows of a task where the work per row is heavy: a compact table packs millions into one split.
ROWS_PER_TASK = 100_000


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_SETTINGS` to an existing session."""
    for name, value in SESSION_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(app_name: str = "extractkit", cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in {**SESSION_SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def spread(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """Use all cores for expensive work on rows read from few files.

    Only for a plain scan.  One that already has a partition per core, as any large
    table does, is left alone; the keys make the new places repeatable.  Where the number of ``rows`` is
    told, there is also one for each :data:`ROWS_PER_TASK` of them.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_TASK))
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, *keys)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local folder is lost with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
    folder = tempfile.mkdtemp(prefix="extractkit-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read again.

    For a result that several steps read: it is computed once, and what is read back
    survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
