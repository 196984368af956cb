"""CSV whose quoted fields hold line breaks, read by many tasks at once.

Where a line break ends a record depends on all quotes before it, so Spark's own reader takes such a file
in one task. Here lines are read from splits of the files as those of a plain text would be. A quote inside
a quoted field is doubled, so a line break lies in a field if and only if the number of quotes before
it is odd, and of a split it is enough to know whether its own number is odd:

1. one pass sums quotes by split, a row per split; a running sum over a file's splits says whether a
   split begins within a field;
2. each split puts its own lines together to records, in one pass; the line that a split ends with and
   the first that the next one begins with may be parts of one record, and only these parts move;
3. records become columns in Spark's parser.

This holds for files in which quotes stand for themselves only when doubled in quoted fields. A line
break within a field is kept as it is; a carriage return before one that ends a record is not.
"""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.plans.session import small_side, staged


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``start`` of the split in the file, and ``value``, in the order of the file within each split."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _states(rows: DataFrame) -> DataFrame:
    """A row per split: its ``number`` within its file, and whether it begins within a field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = rows.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    order = Window.partitionBy("file").orderBy("start")
    before = F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return splits.select("file", "start", (F.row_number().over(order) - 1).alias("number"), (F.coalesce(before, F.lit(0)) % 2 == 1).alias("within"))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split. ``part`` is null for a whole one; else 0 for lines that belong to a record begun
    before, 1 for the last one, which may go on."""
    names = ["file", "number", "place", "part", "record"]
    split, held, within, place, head = None, [], False, 0, False
    found: list[tuple] = []

    def flush() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string()]
        batch = pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate(kinds)], names=names)
        found.clear()
        return batch

    def close(part: int | None) -> None:
        nonlocal place, head
        found.append((*split, place, 0 if head else part, "\n".join(held)))
        place, head = place + 1, False
        held.clear()

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("file", "number", "within", "value")))
        for file, number, begins, value in rows:
            if (file, number) != split:
                if held:
                    close(1)
                split, within, place, head = (file, number), begins, 0, begins
            held.append(value)
            within ^= bool(value.count('"') & 1)
            if not within:
                close(None)
        yield flush()
    if held:
        close(1)
    yield flush()


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``number`` and ``place`` (the record's split and its place in it) and ``record`` of every record."""
    rows = lines(spark, path)
    states = staged(_states(rows), "splits")
    # One row per split of the files.
    cut = rows.join(F.broadcast(states), ["file", "start"]).select("file", "number", "within", "value")
    found = staged(cut.mapInArrow(_assemble, "file string, number int, place long, part int, record string"), "records")
    parts = found.where("part IS NOT NULL")
    # A record begins with the last line of a split and goes on until a part that is followed by whole records.
    begun = F.sum("part").over(Window.partitionBy("file").orderBy("number", "place"))
    joined = parts.withColumn("begun", begun).groupBy("file", "begun").agg(
        F.min(F.struct("number", "place")).alias("at"), F.array_sort(F.collect_list(F.struct("number", "place", "record"))).alias("parts")
    )
    whole = joined.select("file", "at.number", "at.place", F.array_join("parts.record", "\n").alias("record"))
    return found.where("part IS NULL").select("file", "number", "place", "record").unionByName(whole)


def _names(header: str) -> list[str]:
    """Column names; empty and repeated ones get their place, as Spark's reader does it."""
    names = next(csv.reader(io.StringIO(header, newline="")), [])
    repeated = {n for n, count in Counter(name.lower() for name in names).items() if count > 1}
    return [f"_c{i}" if not name else f"{name}{i}" if name.lower() in repeated else name for i, name in enumerate(names)]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header in each file; without a schema, string columns named by the first file's header.

    Columns go by their place. Empty lines are no records. Rows come in no order.
    """
    rows = records(spark, path).withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")
    heads = small_side(rows.groupBy("file").agg(F.min(F.struct("number", "place", "record")).alias("head")))
    if schema is None:
        head = heads.orderBy("file").select("head.record").first()
        if head is None:
            return spark.createDataFrame([], T.StructType())
        schema = T.StructType([T.StructField(name, T.StringType()) for name in _names(head.record)])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    body = rows.join(heads.select("file", "head.number", "head.place"), ["file", "number", "place"], "left_anti")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    return body.select(F.from_csv("record", fields, {"quote": '"', "escape": '"'}).alias("_row")).select("_row.*")
