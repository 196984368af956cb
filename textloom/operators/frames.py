"""Shapes shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def side_by_side(parts: list[DataFrame]) -> DataFrame:
    """One-row frames put next to each other by a union and one aggregate, without a join."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.any_value(name, True).alias(name) for name in stacked.columns])


#: A key with more than one part in so many of all rows is hot; fewer keys than this can be.
HOT_KEYS = 1000


def join_one(many: DataFrame, one: DataFrame, keys: list[str], rows: str, total: int) -> DataFrame:
    """Inner join with a table of one row per key, which knows in ``rows`` how many rows the key has in ``many``.

    Keys with more than a thousandth of the ``total`` of rows, fewer than a thousand, are joined by
    broadcast, so that their rows stay where they are; the others meet in a shuffle without a hot key.
    ``many`` is read twice.
    """
    bound = total // HOT_KEYS
    hot = F.broadcast(one.where(F.col(rows) > bound))
    rest = many.join(hot.select(keys), keys, "left_anti").join(one.where(F.col(rows) <= bound), keys)
    return many.join(hot, keys).unionByName(rest)


def as_map(counts: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """A two-column frame as one row holding a map."""
    return counts.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias(name))


def top_per_group(df: DataFrame, group: str, k: int, *order_by: Column | str) -> DataFrame:
    """The first ``k`` rows of every group, with their rank.

    The rank filter turns into a group limit ahead of the shuffle, so a large group sends at
    most ``k`` rows per map task.
    """
    window = Window.partitionBy(group).orderBy(*order_by)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def tags_union(frames: list[tuple[str, DataFrame]], tag: str) -> DataFrame:
    """Union of frames of one schema, each marked with its name."""
    result = None
    for name, frame in frames:
        marked = frame.withColumn(tag, F.lit(name))
        result = marked if result is None else result.unionByName(marked)
    return result
