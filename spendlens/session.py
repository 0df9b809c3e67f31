"""Spark session helpers.

The engine never owns the cluster configuration: on a cluster the session is
created by the job launcher and we only read from it.  ``get_spark`` exists for
tests, local runs and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "spendlens") -> SparkSession:
    """Build (or reuse) a session with the settings this engine relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    ``spark.checkpoint.dir`` is read from the session.  Where it is unset, a
    local master (tests) gets a fresh scratch folder; on a cluster, where a
    folder of the driver's machine would not be seen by the executors, that is
    an error.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"{CHECKPOINT_CONF} is unset: name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="spendlens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub folder of the shared checkpoint folder, for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss).

    The plan is persisted first so that the checkpoint files are written from
    the blocks computed by the materialising job instead of a second run of
    the whole plan; the blocks are released once the files exist.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist(blocking=False)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there, for a large table
    that is read several times (Parquet, so a reader that needs few columns reads only those)."""
    path = scratch_path(df.sparkSession, f"stored_{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worked_once(df: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(df)`` of a small table, materialised: dealt to all cores first (few bytes would
    come as one task, however long the work on each row), and not repeated by what reads it."""
    return cut_lineage(work(df.repartition(df.sparkSession.sparkContext.defaultParallelism)))
