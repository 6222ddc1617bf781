"""Session builder and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Keeps streaming state on local disk with snapshots in the checkpoint folder,
# instead of in executor memory.
ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_session(app: str = "weirflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    UTC keeps durations and text forms of timestamps independent of the host
    (and of daylight saving). AQE supplies runtime join choice, skew-join
    splitting and partition coalescing. The partition overwrite mode is left
    alone: every sink sets it per write.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
        # Checkpointed rows go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. It has to be configured:
    executors do not see a folder that is local to one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession, root: str) -> Iterator[str]:
    """A fresh folder below a job's root, removed when the job is over."""
    path = f"{root}/_staging/{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back: computed once, with a known size,
    and not lost with an executor."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
