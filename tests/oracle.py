"""Run registered queries beside their SQL checks: python -m tests.oracle [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty when the query equals its check, else what differs."""
    frame = entry.queries()[name](spark, sf_dir)
    got = frame.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if got or name in MAY_BE_EMPTY else "no rows"
    result = con.sql(sql)
    columns, kinds = list(result.columns), [str(kind) for kind in result.types]
    want = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    spark_kinds = dict(frame.dtypes)
    for column, kind in zip(columns, kinds):
        if kind != _KINDS.get(spark_kinds[column]):
            return f"type of {column}: {spark_kinds[column]} != {kind}"
    left, right = _rows(frame.columns, got), _rows(columns, want)
    if left != right:
        return f"{len(got)} rows vs {len(want)}; extra {list((left - right).items())[:3]}; missing {list((right - left).items())[:3]}"
    return "" if got else "both empty"


MAY_BE_EMPTY: set[str] = set()


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in argv[1:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        checked = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'ok  ' if not problem else 'FAIL'} {checked:4} {time.time() - start:6.2f}s {name} {problem}", flush=True)
        bad += bool(problem)
    print(f"{bad} problem(s)")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
