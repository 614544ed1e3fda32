"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Join state goes to RocksDB, so it may outgrow the executor heap; changelog
# checkpoints upload only what a micro-batch changed, and no row count is kept,
# which would cost a look-up per written row.
RECOMMENDED_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

# AQE re-plans joins at run time: it broadcasts a side only when its measured
# size is under the threshold and splits skewed partitions.
RECOMMENDED = {
    **RECOMMENDED_STATE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the recommended settings; ``settings`` win over them.

    Setting names are given with ``__`` for each dot, e.g.
    ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    given = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**RECOMMENDED, **given}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def own_session(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session on the same context and catalog with settings of its own.

    It starts from the SQL settings of ``spark``, which stays as it is.
    """
    session = spark.newSession()
    for row in spark.sql("SET").toLocalIterator():
        if session.conf.isModifiable(row.key):
            session.conf.set(row.key, row.value)
    for name, value in settings.items():
        session.conf.set(name, value)
    return session


# Shuffle files go when the execution that wrote them ends, and not when the
# driver happens to collect its garbage.
_SHORT_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def short_shuffles(spark: SparkSession) -> SparkSession:
    """A session as ``spark`` whose executions leave no shuffle files."""
    return own_session(spark, _SHORT_SHUFFLES)


def measured_broadcasts(spark: SparkSession) -> dict[str, str]:
    """Settings by which a join broadcasts what was measured to be small, and nothing else.

    Plans take the size of files for that of their rows.  Those of a dimension hold
    a hundredth of what its rows take in memory, copies to salts not counted.
    """
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    limit = spark.conf.get(adaptive, None) or spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return {"spark.sql.autoBroadcastJoinThreshold": "-1", adaptive: limit}


def batch_settings(spark: SparkSession) -> dict[str, str]:
    """Settings for batch work whose tasks should not grow with the tables.

    Shuffles start from many partitions, and AQE puts small ones together only up
    to a size whose sorted or hashed rows are small beside a task's memory.
    """
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": _many(spark),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
        **_SHORT_SHUFFLES,
    }


def _many(spark: SparkSession) -> str:
    return str(max(200, 16 * spark.sparkContext.defaultParallelism))


def stream_settings(spark: SparkSession) -> dict[str, str]:
    """Settings for stateful streams on this cluster.

    The number of state partitions stays fixed for the life of a checkpoint, so
    it follows the cores of the cluster and not a default.  Batch work - what a
    micro-batch writes, recomputed tables - starts from more, which AQE puts
    together by their size, so that a task's share does not grow with the tables.
    Shuffle files go when the execution that wrote them ends, joins broadcast
    by measured sizes, and tables are compressed by zstd, as they hold long JSON
    texts.
    """
    return {
        **RECOMMENDED_STATE,
        **_SHORT_SHUFFLES,
        **measured_broadcasts(spark),
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": _many(spark),
        "spark.sql.parquet.compression.codec": "zstd",
    }


_local_scratch: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary
    folder that lives as long as this process.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
    return _local_scratch


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
