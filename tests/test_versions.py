"""Versioned tables: writers that die, readers in between, expiry; staged tables that are cleaned up."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textloom.plans import session
from textloom.sources import versions


def _ids(df):
    return sorted(row.id for row in df.collect())


def test_a_killed_writer_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.versions(spark, path) == [] and versions.write(spark.range(3), path) == 1
    broken = spark.range(100).repartition(4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        versions.write(broken, path)
    assert _ids(versions.read(spark, path)) == [0, 1, 2]
    # Files that a dead writer has left are no version either, not even with their manifest begun.
    spark.range(9).write.parquet(f"{path}/data-00000002-dead")
    (tmp_path / "t/manifests/00000002/_temporary").mkdir(parents=True)
    assert versions.versions(spark, path) == [1] and _ids(versions.read(spark, path)) == [0, 1, 2]


def test_a_table_may_be_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write(spark.range(3), path)
    old = versions.read(spark, path)
    assert versions.write(old.selectExpr("id + 10 AS id"), path, expected=1) == 2
    # The reader of the version before goes on.
    assert _ids(old) == [0, 1, 2] and _ids(versions.read(spark, path)) == [10, 11, 12]
    assert _ids(versions.read(spark, path, 1)) == [0, 1, 2]
    with pytest.raises(RuntimeError, match="version 2, not at 1"):
        versions.write(old, path, expected=1)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path, 7)


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.write(spark.range(1), path)
    real = versions.versions
    with monkeypatch.context() as late:
        late.setattr(versions, "versions", lambda *_: real(spark, path))
        versions.write(spark.range(2), path)
        # This one looked before the other had finished.
        late.setattr(versions, "versions", lambda *_: [1])
        with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
            versions.write(spark.range(5), path)
    assert _ids(versions.read(spark, path)) == [0, 1]


def test_expiry(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        versions.write(spark.range(n), path)
    spark.range(9).write.parquet(f"{path}/data-00000003-dead")
    spark.range(9).write.parquet(f"{path}/data-00000005-busy")
    assert versions.versions(spark, path) == [4, 3]
    assert versions.expire(spark, path, keep=1) and versions.versions(spark, path) == [4]
    left = sorted(p.name[:13] for p in (tmp_path / "t").glob("data-*"))
    assert left == ["data-00000004", "data-00000005"] and _ids(versions.read(spark, path)) == [0, 1, 2, 3]
    assert versions.as_of(spark, path).count() == 1 and versions.expire(spark, str(tmp_path / "none")) == []
    with pytest.raises(ValueError):
        versions.expire(spark, path, keep=0)


def test_staged_tables_go_at_the_end_of_their_block(spark):
    with session.scratch(spark) as paths:
        with session.scratch(spark) as inner:
            assert session.staged(spark.range(3), "inner").count() == 3
        outer = session.staged(spark.range(4), "outer")
        assert outer.count() == 4 and len(paths) == len(inner) == 1
        assert session.FileSystem(spark, inner[0]).names(inner[0]) == []
        assert session.FileSystem(spark, paths[0]).names(paths[0])
    assert session.FileSystem(spark, paths[0]).names(paths[0]) == []
    kept = session.staged(spark.range(2), "kept")
    assert kept.count() == 2
