"""Browsing a table page by page in a fixed order, without sorting it for every page.

A listing is the table written once, in order: rows are range-partitioned and sorted, and each part is a
folder of its own. Beside them lies one small row per part: its number of rows, the position of its first
one and its smallest and largest key. A page is then a matter of looking up which parts it touches; the scan
prunes all other folders, so the millionth page costs as much as the first. Keyset paging starts after a
given row instead of a position, and so stays put where positions shift, and allows for filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLACES = (1 << 33) - 1


@dataclass(frozen=True)
class Listing:
    """A table in the order of some of its columns, at a path."""

    spark: SparkSession
    path: str
    order_by: tuple[str, ...]
    schema: T.StructType | None = None

    @staticmethod
    def write(df: DataFrame, path: str, order_by: Sequence[str], parts: int | None = None) -> Listing:
        """Write the listing of a frame. The order has to be total; null keys come first."""
        spark, keys = df.sparkSession, [F.col(name) for name in order_by]
        ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
        row_id = F.monotonically_increasing_id()
        rows = ranged.sortWithinPartitions(*keys).withColumns({"_part": F.shiftright(row_id, 33), "_place": row_id.bitwiseAND(F.lit(_PLACES))})
        rows.write.partitionBy("_part").parquet(f"{path}/rows")
        key = F.struct(*order_by)
        schema = T.StructType([*df.schema, T.StructField("_place", T.LongType()), T.StructField("_part", T.LongType())])
        listing = Listing(spark, path, tuple(order_by), schema)
        bounds = listing._rows().groupBy("_part").agg(F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))
        bounds.coalesce(1).write.parquet(f"{path}/parts")
        return listing

    def _rows(self) -> DataFrame:
        reader = self.spark.read.schema(self.schema) if self.schema is not None else self.spark.read
        return reader.parquet(f"{self.path}/rows")

    @cached_property
    def parts(self) -> list[Row]:
        """The parts in order. One small row each; there are as many as tasks that wrote them."""
        return sorted(self.spark.read.parquet(f"{self.path}/parts").collect(), key=lambda row: row["_part"])

    @property
    def rows(self) -> int:
        return sum(part["rows"] for part in self.parts)

    def _read(self, parts: Sequence[int]) -> DataFrame:
        """Rows of some parts; the folders of all others are pruned."""
        rows = self._rows()
        return rows.where(F.col("_part").isin(list(parts))) if parts else rows.where(F.lit(False))

    def between(self, first: int, last: int) -> DataFrame:
        """The rows at positions from ``first`` up to, but not with, ``last``, with their ``pos``."""
        start, wanted, condition = 0, [], F.lit(False)
        for part in self.parts:
            end = start + part["rows"]
            if start < last and first < end:
                wanted.append(part["_part"])
                place = F.col("_place").between(max(first - start, 0), min(last, end) - start - 1)
                condition = condition | ((F.col("_part") == part["_part"]) & place)
            start = end
        offset = {part["_part"]: at for part, at in zip(self.parts, self._starts)}
        pos = F.lit(0)
        for part in wanted:
            pos = F.when(F.col("_part") == part, F.lit(offset[part])).otherwise(pos)
        found = self._read(wanted).where(condition).withColumn("pos", (pos + F.col("_place")).cast("long"))
        return found.drop("_part", "_place").orderBy("pos")

    @property
    def _starts(self) -> list[int]:
        starts = [0]
        for part in self.parts:
            starts.append(starts[-1] + part["rows"])
        return starts

    def page(self, number: int, size: int = 10) -> DataFrame:
        """Page ``number`` (from 1)."""
        first = (max(number, 1) - 1) * size
        return self.between(first, first + size)

    def after(self, key: Sequence | None, size: int = 10, where: Column | None = None) -> DataFrame:
        """The next ``size`` rows after the row with this key (``None``: from the start) that satisfy the condition.

        As many parts are read as it takes, twice as many each time."""
        order = [F.col(name) for name in self.order_by]
        left = [part for part in self.parts if key is None or _precedes(tuple(key), tuple(part["high"]))]
        taken = 1
        while True:
            chosen = left[:taken]
            rows = self._read([part["_part"] for part in chosen])
            if key is not None:
                rows = rows.where(_beyond(self.order_by, key))
            if where is not None:
                rows = rows.where(where)
            found = rows.drop("_part", "_place").orderBy(*order).limit(size)
            # Without a filter the parts' sizes tell; the first part may be begun.
            enough = sum(part["rows"] for part in chosen[1:]) >= size if where is None else None
            if len(chosen) == len(left) or (enough if enough is not None else found.count() == size):
                return found
            taken *= 2


def _precedes(left: tuple, right: tuple) -> bool:
    """Whether a key comes before another; nulls come first."""
    place = lambda key: tuple((value is not None, value) if value is not None else (False,) for value in key)
    return place(left) < place(right)


def _beyond(names: Sequence[str], key: Sequence) -> Column:
    """Rows whose key comes after the given one, column by column; nulls come first."""
    result, same = F.lit(False), F.lit(True)
    for name, value in zip(names, key, strict=True):
        column = F.col(name)
        larger = column.isNotNull() if value is None else F.coalesce(column > F.lit(value), F.lit(False))
        result = result | (same & larger)
        same = same & column.eqNullSafe(F.lit(value))
    return result
