"""CSV read in many tasks against Spark's own reader, which takes a file with line breaks in one."""

from __future__ import annotations

import random

import pytest

from textloom.sources import ingest, records


@pytest.fixture()
def small_splits(spark):
    """Splits of a few dozen bytes, so that records begin and end in many of them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size: int) -> None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{size}b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    for key, value in old.items():
        spark.conf.set(key, value)


def _field(rnd: random.Random) -> str:
    text = "".join(rnd.choice(["a", "é", " ", ",", "\n", '"', "日", "x\ny", "\r\n", "'"]) for _ in range(rnd.randint(0, 14)))
    return f'"{text.replace(chr(34), chr(34) * 2)}"' if rnd.random() < 0.8 or set(text) & set(',"\n\r') or text != text.strip() else text


def _write(folder, seed: int, files: int = 2, end: str = "\n") -> str:
    rnd = random.Random(seed)
    folder.mkdir()
    for n in range(files):
        rows = ['id,"te\nxt",other'] + [f"{n}-{i},{_field(rnd)},{_field(rnd)}" for i in range(120)]
        if seed % 2:
            rows.insert(50, "")
        (folder / f"f{n}.csv").write_bytes((end.join(rows) + (end if seed % 3 else "")).encode())
    return str(folder)


@pytest.mark.parametrize("seed, size", [(1, 40), (2, 97), (3, 500), (4, 1 << 20)])
def test_rows_equal_the_reader_of_whole_files(spark, small_splits, tmp_path, seed, size):
    path = _write(tmp_path / "in", seed)
    want = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    columns, rows = want.columns, sorted(map(tuple, want.collect()), key=str)
    small_splits(size)
    got = records.read_csv(spark, path)
    assert got.columns == columns and sorted(map(tuple, got.collect()), key=str) == rows
    assert len(rows) == 240


def test_a_file_is_read_by_many_tasks(spark, small_splits, tmp_path):
    path = _write(tmp_path / "in", 5, files=1)
    assert spark.read.csv(path, header=True, multiLine=True).rdd.getNumPartitions() == 1
    small_splits(200)
    assert records.lines(spark, path).rdd.getNumPartitions() > 5
    splits = {r.number for r in records.records(spark, path).select("number").distinct().collect()}
    assert len(splits) > 5


def test_a_record_over_many_splits_and_windows_line_ends(spark, small_splits, tmp_path):
    (tmp_path / "in").mkdir()
    long = "line\n" * 200 + '""quoted""\n' + "end"
    (tmp_path / "in/a.csv").write_bytes(f'k,v\r\n1,"{long}"\r\n\r\n2,plain\r\n3,""\r\n'.encode())
    small_splits(64)
    rows = {r.k: r.v for r in records.read_csv(spark, str(tmp_path / "in")).collect()}
    assert rows == {"1": long.replace('""', '"'), "2": "plain", "3": None}


def test_schemas_headers_and_empty_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text('a,,A,b\n1,2,3,"x"\n')
    (tmp_path / "in/b.csv").write_text("")
    want = spark.read.csv(str(tmp_path / "in/a.csv"), header=True, multiLine=True)
    got = records.read_csv(spark, str(tmp_path / "in"))
    assert got.columns == want.columns and got.collect() == want.collect()
    typed = records.read_csv(spark, str(tmp_path / "in"), "p int, q double, r string, s string").collect()
    assert [tuple(r) for r in typed] == [(1, 2.0, "3", "x")]
    (tmp_path / "none").mkdir()
    (tmp_path / "none/c.csv").write_text("")
    assert records.read_csv(spark, str(tmp_path / "none")).count() == 0


def test_ingest_reads_through_it(spark, small_splits, tmp_path):
    rows = [(str(i), f'text {i}, with "quotes"\nand a second line', "safety", 0.25, "rss", "safety", None) for i in range(50)]
    spark.createDataFrame(rows, ingest.REVIEW_QUEUE_SCHEMA).coalesce(1).write.csv(str(tmp_path / "queue"), header=True, quoteAll=True, escape='"')
    small_splits(100)
    got = sorted(map(tuple, ingest.read_review_queue(spark, str(tmp_path / "queue")).collect()))
    assert got == sorted(rows)
