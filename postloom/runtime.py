"""Session settings and durable scratch tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # JSON work is heavy for its bytes, so small shuffles keep more tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # A log is read by the paths of its files, of which a listing task takes many.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    # Sessions are merged inside each input partition before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # Shuffle files go when the run that made them ends, not when the driver's heap is next collected.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are tuned for."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """No rows, as the optimizer knows: it drops unions and joins with them, and no task runs."""
    return spark.createDataFrame([], ddl).limit(0)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="postloom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/postloom/{uuid.uuid4().hex}/{name}"


_run = threading.local()


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that `durable` writes inside, once what is made of them is written."""
    outer, _run.made = getattr(_run, "made", None), []
    try:
        yield
    finally:
        made, _run.made = _run.made, outer
        for path in made:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


# For tables of JSON texts (a column `data`), which then take half the place.
DENSE = "zstd"


def durable(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Fixes values that must not change when a stage is run again (such as the
    range a row fell into) and lets later passes read single columns. With a `path` of the
    caller's own, the caller also deletes it.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, name)
        if getattr(_run, "made", None) is not None:
            _run.made.append(path.rsplit("/", 1)[0])
    df.write.parquet(path, compression=DENSE if "data" in df.columns else None)
    return spark.read.schema(df.schema).parquet(path)
