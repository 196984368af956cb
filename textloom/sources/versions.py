"""Tables that are replaced as a whole without a moment in which they are gone.

Spark's overwrite deletes the old files before it writes the new ones, so a job that dies in between leaves
nothing, and one that reads its own table cannot write it. A versioned table is a folder with

* ``data-<version>-<id>``: the files of one version, written first;
* ``manifests/<version>``: which folder a version is, written last, by Spark's own commit.

Readers take the version with the largest number; one that has been planned stays valid until it expires.
Writers of the same version collide on the manifest, and the later one fails. What a killed writer
leaves is no version, and is removed together with the expired ones.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.plans.session import FileSystem

#: Versions that stay readable after a write.
KEEP = 2
_MANIFEST = "version long, folder string, columns string"


def _manifests(spark: SparkSession, path: str) -> list:
    """The versions, newest first; one small row each, and expiry keeps them few."""
    try:
        rows = spark.read.schema(_MANIFEST).json(f"{path}/manifests/*")
        return sorted(rows.collect(), key=lambda row: -row.version)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the readable versions, newest first."""
    return [row.version for row in _manifests(spark, path)]


def write(df: DataFrame, path: str, keep: int = KEEP, expected: int | None = None) -> int:
    """Write the frame as the next version and return its number; older versions than the last ``keep`` expire.

    With ``expected``, the version that the frame was made from (0: none), another writer's version in
    between is an error, and no update gets lost.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    newest = max(versions(spark, path), default=0)
    if expected is not None and expected != newest:
        raise RuntimeError(f"{path} is at version {newest}, not at {expected}")
    folder = f"data-{newest + 1:08d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    row = spark.createDataFrame([(newest + 1, folder, df.schema.json())], _MANIFEST).coalesce(1)
    # Fails where another writer has made this version.
    row.write.mode("errorifexists").json(f"{path}/manifests/{newest + 1:08d}")
    expire(spark, path, keep)
    return newest + 1


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of a table, or the given one."""
    path = path.rstrip("/")
    for row in _manifests(spark, path):
        if version in (None, row.version):
            return spark.read.parquet(f"{path}/{row.folder}")
    raise FileNotFoundError(f"no version {'' if version is None else f'{version} '}of a table at {path}")


def read_first_existing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first of several tables that has a version."""
    for path in paths:
        try:
            return read(spark, path)
        except FileNotFoundError:
            continue
    raise FileNotFoundError(f"none of these tables exists: {', '.join(paths)}")


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> list[str]:
    """Remove all but the last ``keep`` versions, and what writers that died have left; returns what went.

    The manifest goes before the files, so that no version is listed whose files are gone. Folders of a version
    beyond the newest may be someone's who is still writing, and stay."""
    if keep < 1:
        raise ValueError("one version has to stay")
    rows = _manifests(spark, path)
    if not rows:
        return []
    kept = {row.folder for row in rows[:keep]}
    files = FileSystem(spark, path)
    removed = []
    for row in rows[keep:]:
        files.delete(f"{path}/manifests/{row.version:08d}")
    for name in files.names(path):
        if name.startswith("data-") and name not in kept and int(name.split("-")[1]) <= rows[0].version:
            files.delete(f"{path}/{name}")
            removed.append(name)
    return removed


def as_of(spark: SparkSession, path: str) -> DataFrame:
    """The versions with their folders, as a table."""
    rows = [(row.version, row.folder) for row in _manifests(spark, path)]
    return spark.createDataFrame(rows, "version long, folder string").orderBy(F.desc("version"))
