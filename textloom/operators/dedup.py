"""Keep-first deduplication, global positions and near-duplicate pairs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import patterns as P
from textloom.functions.text import digest, is_blank
from textloom.plans.session import staged

# Rows scored together. A task holds at most this many rows plus one window of following rows.
PAIR_BLOCK = 512
# Histogram size and counts that one edit may change: characters, trigrams.
_PROFILES = ((256, 1), (2048, 5))
_CHECK_EVERY = 128


def keep_first(df: DataFrame, key: Column, order_by: list[str]) -> DataFrame:
    """First row of every key in the given order.

    Rank-one filters on a window become a group limit that already runs before the shuffle, so
    a key that holds a third of all rows sends one row per map task. The order must be total.
    """
    first = Window.partitionBy("_key").orderBy(*order_by)
    return (
        df.withColumn("_key", digest(key))
        .withColumn("_rank", F.row_number().over(first))
        .where("_rank = 1")
        .drop("_key", "_rank")
    )


def duplicate_count(key: Column, blank_counts: bool) -> Column:
    """Aggregate: rows beyond the first per key; blank keys may be left out."""
    key_digest = digest(key)
    if not blank_counts:
        key_digest = F.when(key != "", key_digest)
    return F.count(key_digest) - F.countDistinct(key_digest)


def with_position(df: DataFrame, order_by: list[str], name: str = "pos") -> DataFrame:
    """Add the zero-based position of every row in the given total order.

    Rows are range-partitioned and sorted, their place within the partition is written with
    them, and per-partition counts give the offsets. Only the offsets, one row per partition,
    pass through a single task.
    """
    row_id = F.monotonically_increasing_id()
    ranged = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.shiftright(row_id, 33))
        .withColumn("_place", row_id.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = staged(ranged, "positions")
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


def _char_places(text: str) -> dict[str, int]:
    """For every character of the text, an integer with a bit set at each of its places."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(codes) and codes.max() < 256:
        codes = codes.astype(np.uint8)
    return {
        chr(code): int.from_bytes(np.packbits(codes == code, bitorder="little").tobytes(), "little")
        for code in np.unique(codes).tolist()
    }


def common_subsequence(
    left: str, right: str, max_edits: float = math.inf, places: dict[str, int] | None = None
) -> int | None:
    """Length of the longest common subsequence, by bit-parallel dynamic programming.

    ``None`` as soon as no alignment with at most ``max_edits`` insertions and deletions is
    left. ``places`` may be given when ``left`` meets several texts. An alignment with so few edits
    never leaves a band around the diagonal, so only the bits within the band are computed.
    """
    width, height = len(left), len(right)
    if left == right:
        return width
    if abs(width - height) > max_edits:
        return None
    places = _char_places(left) if places is None else places
    spare = min(max_edits, width + height)
    # How far an alignment can be ahead in the left text, and how far in the right one.
    ahead, behind = int(spare + width - height) // 2 + 1, int(spare + height - width) // 2 + 1
    # Bits ``low`` to ``high`` of the row, and what was common before them.
    low, high, before, row = 0, 0, 0, 0
    for done in range(0, height, _CHECK_EVERY):
        part = right[done : done + _CHECK_EVERY]
        first, last = min(max(0, done - behind), width), min(done + len(part) + ahead, width)
        if first > low:
            before += first - low - (row & ((1 << (first - low)) - 1)).bit_count()
            row >>= first - low
        # Columns that the band reaches only now have nothing more in common than those before.
        row |= (1 << (last - first)) - (1 << (high - first)) if last > high else 0
        low, high = first, max(last, high)
        full = (1 << (high - low)) - 1
        own = {char: places.get(char, 0) >> low & full for char in set(part)}
        for char in part:
            matches = row & own[char]
            if matches:
                row = (row + matches) | (row - matches)
        # Carries beyond the band change nothing below it.
        row &= full
        # Before that, texts with anything in common are not that far apart.
        if done + len(part) > 0.6 * max_edits and _least_edits(row, low, high, before, width, done + len(part), height) > max_edits:
            return None
    common = before + (high - low) - row.bit_count()
    return common if width + height - 2 * common <= max_edits else None


def _least_edits(row: int, low: int, high: int, before: int, width: int, done: int, height: int) -> int:
    """Fewest edits of any alignment within the band, given the row of the dynamic programme after ``done``
    characters: edits so far plus the difference in what is left on both sides."""
    size = high - low
    packed = np.frombuffer(row.to_bytes((size + 7) // 8, "little"), dtype=np.uint8)
    common = np.concatenate(([before], before + np.cumsum(1 - np.unpackbits(packed, bitorder="little", count=size).astype(np.int64))))
    taken = np.arange(low, high + 1)
    return int((taken + done - 2 * common + np.abs((width - taken) - (height - done))).min())


def similarity(left: str, right: str, threshold: float = 0.0, places: dict[str, int] | None = None) -> float:
    """Normalised insert/delete similarity in 0..100; 0.0 when it is below the threshold."""
    total = len(left) + len(right)
    if total == 0:
        return 100.0
    common = common_subsequence(left, right, (1.0 - threshold / 100.0) * total + 1e-6, places)
    score = 0.0 if common is None else (1.0 - (total - 2 * common) / total) * 100.0
    return score if score >= threshold else 0.0


def _profiles(text: str) -> list[np.ndarray]:
    """Histogram of characters and hashed histogram of character trigrams."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    grams = codes[:-2] * 1_000_003 + codes[1:-1] * 10_007 + codes[2:]
    return [
        np.bincount(values % size, minlength=size).astype(np.int32)
        for values, (size, _) in zip((codes, grams), _PROFILES)
    ]


def _candidates(texts: list[str], usable: np.ndarray, own: np.ndarray, window: int, threshold: float):
    """Pairs within the window that no cheap bound rules out.

    Bounds are the difference in length and the distance of two histograms: one edit changes
    the histogram of n-grams by at most ``2 * n - 1`` counts. They lose no pair.
    """
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    tables = [np.stack(column) for column in zip(*map(_profiles, texts))]
    for gap in range(1, min(window, len(texts) - 1) + 1):
        edits = (1.0 - threshold / 100.0) * (lengths[:-gap] + lengths[gap:]) + 1e-6
        keep = own[:-gap] & usable[:-gap] & usable[gap:]
        keep &= np.abs(lengths[:-gap] - lengths[gap:]) <= edits
        first = np.flatnonzero(keep)
        for table, (_, per_edit) in zip(tables, _PROFILES):
            apart = np.abs(table[first] - table[first + gap]).sum(axis=1)
            first = first[apart <= per_edit * edits[first]]
        for index in first:
            yield int(index), int(index) + gap


_PAIR_SCHEMA = "pos_1 bigint, pos_2 bigint, text_1 string, text_2 string, similarity double"


def _block_scorer(window: int, threshold: float):
    def score(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        texts = block["text"].tolist()
        positions = block["pos"].to_numpy()
        usable = ~block["blank"].to_numpy(dtype=bool)
        own = ~block["halo"].to_numpy(dtype=bool)
        rows = []
        last, places = -1, None
        for i, j in sorted(_candidates(texts, usable, own, window, threshold)):
            if i != last:
                last, places = i, _char_places(texts[i])
            score = similarity(texts[i], texts[j], threshold, places)
            if score >= threshold:
                rows.append((positions[i], positions[j], texts[i][:100], texts[j][:100], round(score, 2)))
        return pd.DataFrame(rows, columns=["pos_1", "pos_2", "text_1", "text_2", "similarity"])

    return score


def fuzzy_pairs(
    positioned: DataFrame,
    text_col: str = "text",
    pos_col: str = "pos",
    threshold: float = P.FUZZY_THRESHOLD,
    window: int = P.FUZZY_WINDOW,
) -> DataFrame:
    """Pairs of rows at most ``window`` positions apart whose similarity reaches the threshold.

    Consecutive rows are cut into blocks of fixed size; each block also receives the first
    ``window`` rows of the next one. A group therefore has at most ``PAIR_BLOCK + window`` rows
    whatever the data, and every text is shipped about once instead of once per pair.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    size = max(PAIR_BLOCK, window)
    block = F.floor(F.col(pos_col) / size)
    own = F.struct(block.alias("block"), F.lit(False).alias("halo"))
    previous = F.struct((block - 1).alias("block"), F.lit(True).alias("halo"))
    is_head = (F.col(pos_col) % size < window) & (block > 0)
    return (
        positioned.select(
            F.col(pos_col).alias("pos"),
            F.col(text_col).alias("text"),
            is_blank(F.col(text_col)).alias("blank"),
            F.explode(F.when(is_head, F.array(own, previous)).otherwise(F.array(own))).alias("_slot"),
        )
        .select("pos", "text", "blank", "_slot.block", "_slot.halo")
        .groupBy("block")
        .applyInPandas(_block_scorer(window, threshold), _PAIR_SCHEMA)
    )


def candidate_pairs(
    positioned: DataFrame,
    text_col: str = "text",
    pos_col: str = "pos",
    threshold: float = P.FUZZY_THRESHOLD,
    window: int = P.FUZZY_WINDOW,
) -> DataFrame:
    """The pairs of :func:`fuzzy_pairs` before scoring: band and length bound, lengths only.

    A band join as an equality join on window-sized buckets. Texts stay behind: each row brings
    only its position and length.
    """
    rows = positioned.where(~is_blank(F.col(text_col))).select(
        F.col(pos_col).alias("pos"), F.length(text_col).cast("bigint").alias("len")
    )
    bucket = F.floor(F.col("pos") / window)
    left = rows.select(
        F.col("pos").alias("pos_1"), F.col("len").alias("len_1"),
        F.explode(F.array(bucket, bucket + 1)).alias("bucket"),
    )
    right = rows.select(F.col("pos").alias("pos_2"), F.col("len").alias("len_2"), bucket.alias("bucket"))
    bound = 200.0 * F.least("len_1", "len_2") / (F.col("len_1") + F.col("len_2"))
    return (
        left.join(right, "bucket")
        .where((F.col("pos_2") > F.col("pos_1")) & (F.col("pos_2") <= F.col("pos_1") + window))
        .where(bound >= threshold)
        .select("pos_1", "pos_2", "len_1", "len_2")
    )


def drop_fuzzy_duplicates(positioned: DataFrame, pairs: DataFrame, pos_col: str = "pos") -> DataFrame:
    """Remove the later row of every pair, even where the earlier one is removed as well."""
    later = pairs.select(F.col("pos_2").alias(pos_col)).distinct()
    return positioned.join(later, pos_col, "left_anti")
