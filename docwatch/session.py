"""Shared-folder tables and other session-level helpers."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local path would be lost with its machine, so a missing setting is
    an error there.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="docwatch-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never used path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, survives the loss of any executor, is computed
    once however often it is used, and gives the optimizer true sizes.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._shared_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`materialize` that nothing will read any more.

    For rounds: once a round's result is written, the one before it can go.
    """
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._shared_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path, and the path for it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place by one rename; False, with nothing changed, if there is one already."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    folder, _, name = path.rpartition("/")
    files, draft = file_system(spark, f"{folder}/draft-{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    renamer = hadoop.FileContext.getFileContext(draft.toUri(), context._jsc.hadoopConfiguration())
    options = context._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        renamer.rename(renamer.makeQualified(draft), renamer.makeQualified(hadoop.Path(f"{folder}/{name}")), options)
    except Exception as error:
        if "AlreadyExists" not in str(error):
            raise
        files.delete(draft, False)
        return False
    return True


def instant(as_of: datetime) -> Column:
    """A timestamp literal that doesn't depend on the session time zone."""
    return F.timestamp_micros(F.lit(_micros(as_of)))


def _micros(moment: datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    delta = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
