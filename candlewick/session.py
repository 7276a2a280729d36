"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window state of a long backfill belongs on disk, not on the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_MADE: list[str] = []  # work folders of this process, deleted when it ends


def configure(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on: UTC session time, adaptive execution, stream state on disk."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the cluster's shared ``spark.checkpoint.dir``, deleted when the process ends.

    Only a local session may leave the setting out; executors of a cluster
    could not read a folder of the driver's machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = os.path.join(tempfile.gettempdir(), "candlewick")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(clear_work)
    _MADE.append(path)
    return path


def clear_work(spark: SparkSession | None = None) -> None:
    """Delete this process's work folders. Runs by itself at the end; call it earlier once all results are written."""
    spark = spark or SparkSession.getActiveSession()
    while spark is not None and _MADE:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new work folder and read it back.

    For small intermediate results that several branches must see alike: the
    files survive lost executors, and their size tells Spark whether a join may
    broadcast them.
    """
    spark = df.sparkSession
    folder = work_folder(spark, name)
    df.write.parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out._work_folder = folder
    return out


def release(*frames: DataFrame) -> None:
    """Delete the work folders of frames that ``stored`` returned, once nothing reads them any more."""
    for frame in frames:
        path = getattr(frame, "_work_folder", None)
        if path in _MADE:
            _MADE.remove(path)
            spark = frame.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
