"""Session settings, scratch folders and scan sizing."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPREAD_TASKS_PER_CORE = 2
# What a task counts words of, so that its counts fit its memory.
SPREAD_TASK_BYTES = 16 << 20
# An estimate beyond this stands for an unknown size.
KNOWN_BYTES = 1 << 50

# Streaming state on local disk, uploaded as change logs, so that a large vocabulary
# neither fills the heap nor is copied whole at each trigger.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS_PER_CORE = 4


def session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job relies on; `conf` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STATE_SETTINGS,
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    use_cluster_sizes(spark)
    return spark


def use_cluster_sizes(spark: SparkSession) -> None:
    """On a cluster, start shuffles with a few partitions per core unless set otherwise.

    Spark's default of 200 would make each reduce task of a large vocabulary spill. Too
    many cost little, since adaptive execution joins small ones.
    """
    context = spark.sparkContext
    if context.master.startswith("local") or spark.conf.get(INITIAL_PARTITIONS, None):
        return
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(shuffles, context.defaultParallelism * PARTITIONS_PER_CORE)
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, under `spark.checkpoint.dir`.

    Where the setting is absent only a local master may fall back to this machine's
    temporary folder; on a cluster that folder would not be shared, so this raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "termtide")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def use_disk_state(spark: SparkSession) -> None:
    """Apply the state settings to a session made elsewhere."""
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)


def spread_tasks(df: DataFrame) -> int | None:
    """Number of tasks a batch scan should be spread over, or None to leave it as it is.

    A Parquet row group cannot be split, so a small table arrives in fewer tasks than there
    are cores, and tokenizing it would leave the others idle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return cores * SPREAD_TASKS_PER_CORE if df.rdd.getNumPartitions() < cores else None


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan of few tasks over all cores; streams come back unchanged."""
    tasks = None if df.isStreaming else spread_tasks(df)
    return df.repartition(tasks) if tasks else df


def spread_in_time(df: DataFrame, time: str, size: int | None = None) -> DataFrame:
    """The rows of a table that have a time, each task holding a span of it; streams as they are.

    Rows of near times then meet before counts of time windows are shuffled. Equal times may be
    dealt over several tasks. `size` in bytes is given where Spark has no estimate, as for a
    batch of a stream.
    """
    if df.isStreaming:
        return df
    if size is None:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = df.sparkSession.sparkContext.defaultParallelism * SPREAD_TASKS_PER_CORE
    if size < KNOWN_BYTES:
        tasks = max(tasks, size // SPREAD_TASK_BYTES)
    place = "_place"
    placed = df.where(F.col(time).isNotNull()).withColumn(place, F.monotonically_increasing_id())
    return placed.repartitionByRange(tasks, time, place).drop(place)
