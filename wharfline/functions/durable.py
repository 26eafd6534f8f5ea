"""Cutting lineage in storage that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster
    every machine must see the same one, so an unset folder is an error there.
    """
    if _SCOPES:
        return _SCOPES[-1]
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="wharfline-")
        spark.sparkContext.setCheckpointDir(configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


_SCOPES: list[str] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """A folder for all copies made inside, removed at the end.

    Frames made inside must be written or collected before the scope ends;
    without a scope, copies stay until the shared folder is emptied.

        with scope(spark):
            query(spark, folder).write.parquet(target)
    """
    context = spark.sparkContext
    before = shared_folder(spark)
    place = f"{before.rstrip('/')}/scope-{uuid.uuid4().hex}"
    _SCOPES.append(place)
    context.setCheckpointDir(place)
    try:
        yield place
    finally:
        _SCOPES.remove(place)
        context.setCheckpointDir(_SCOPES[-1] if _SCOPES else before)
        removed(spark, place)


def durable(df: DataFrame) -> DataFrame:
    """Write the rows out once and go on from the written copy.

    Later reads see the same rows in the same partitions, whatever executors
    are lost in between.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """The rows written as parquet in the shared folder and read again: by columns, compressed, with statistics."""
    return stored_at(df, scratch_path(df.sparkSession, name))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a copy that nothing will read again."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query run inside go when it ends, not when the garbage collector finds them."""
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of the innermost scope, or else in the shared folder."""
    folder = _SCOPES[-1] if _SCOPES else f"{shared_folder(spark).rstrip('/')}/wharfline"
    return f"{folder}/{name}-{uuid.uuid4().hex}"
