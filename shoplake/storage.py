"""Shared working storage and table writes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Of large tables; about a quarter smaller than Spark's default.
COMPRESSION = "zstd"

# Folder of each stored table that is in use.
_STORED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"shoplake-{application_id}-")


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the session.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return _local_dir(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, in a folder per application.

    Nothing reads that folder once the application has ended.
    """
    application = spark.conf.get("spark.app.id", "session")
    return f"{shared_dir(spark)}/shoplake/{application}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    What follows reads files, so a lost executor costs a re-read of its splits
    and never a second, possibly different, evaluation of ``df``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _STORED[stored] = path
    return stored


def materialize_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """The parts of a table, each written by itself and all read back as one.

    What a part has shuffled is deleted before the next one runs.
    """
    path = None
    for df in parts:
        path = path or scratch_path(df.sparkSession, label)
        df.write.mode("append").parquet(path, compression=COMPRESSION)
        free_shuffles(df.sparkSession)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _STORED[stored] = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete what ``materialize`` has written, once nothing that is still to run reads it.

    Shuffle files of steps that have ended go too.
    """
    for df in stored:
        remove(df.sparkSession, _STORED.pop(df))
    free_shuffles(stored[0].sparkSession)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that have ended.

    It does so when the driver collects its garbage, of which a driver that only plans
    has so little that the files of a whole run would stay.
    """
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the session's file systems; one that does not exist is passed over."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None
) -> DataFrame:
    """Full refresh (``overwrite``) or accumulation (``append``); returns the stored table."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
