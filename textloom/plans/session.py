"""Shared storage for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, the tables go below
    ``spark.sql.warehouse.dir``, which is shared wherever Spark's own tables are.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/textloom"
    return folder.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table."""
    return f"{shared_dir(spark)}/textloom-{name}-{uuid.uuid4().hex}"


class FileSystem:
    """The file system of a path, as Spark's own jobs reach it, for names and deletions."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        """Names of what lies in a folder, none if it does not exist."""
        folder = self._path(path)
        return sorted(x.getPath().getName() for x in self._files.listStatus(folder)) if self._files.exists(folder) else []

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables staged within the block are deleted at its end, so use or write what is made of them before that."""
    paths: list[str] = []
    _scratch.append(paths)
    try:
        yield paths
    finally:
        _scratch.remove(paths)
        for path in paths:
            FileSystem(spark, path).delete(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the frame once to shared storage and read it back.

    Cuts the lineage in a way that survives the loss of executors, and pins the values of
    expressions that depend on the physical layout. The table stays until the folder is emptied, or until
    the end of a :func:`scratch` block around it.
    """
    path = stage_path(df.sparkSession, name)
    if _scratch:
        _scratch[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame) -> DataFrame:
    """A table that is expected, but not certain, to be small: a join side or a report's groups.

    It is written once, so it is computed once however often it is used, and Spark knows its bytes: joins
    broadcast it below ``spark.sql.autoBroadcastJoinThreshold`` and shuffle beyond. No row passes the driver.
    """
    return staged(df, "side")
