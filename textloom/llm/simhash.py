"""Near-duplicates by 64-bit SimHash, found exactly through anchor points.

A fingerprint is cut into two halves of 32 bits. Two fingerprints at most 3 bits apart differ in
at most one bit in one of the halves. The anchors of a half are the words of a Hamming code over 31
of its bits, with the last bit free: the code covers everything within radius 1. Each fingerprint
has its home at the anchor that covers it and visits all anchors within radius 1 plus threshold 1,
about 17 for each half; the home of one of two linked fingerprints is visited by the other. Homes
and visitors of an anchor are compared there. An anchor with many fingerprints is cut into blocks,
and each block of homes meets each block of visitors in a task of its own, so no group grows with
the data and no pair is lost. Only a spanning forest of each block's links leaves it.

Equal texts meet as one fingerprint, so copies cost nothing beyond their own row.

Defined results: a null or empty text, or one without words, has fingerprint zero, which is linked
like any other; texts with fewer words than a shingle are one shingle; repeated rows keep their
fingerprint and component each; a null key is never the name of a component that has other keys;
an empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import worker
from textloom.llm.components import components
from textloom.plans.session import staged

#: Homes and visitors that meet in one block.
BLOCK = 2048
#: Pairs that a task compares at once.
_PAIRS = 1 << 18


def fingerprint_texts(rows: list[bytes], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """Unsigned 64-bit fingerprints of whole texts."""
    digest, hashes, counts = xxhash.xxh64_intdigest, [], []
    for text in rows:
        words = text.lower().split()
        joined = b" ".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size + 1) - 1
        starts = (ends - size).tolist()
        ends = ends.tolist()
        if len(words) > shingle:
            hashes += [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :])]
            counts.append(len(words) - shingle + 1)
        else:
            hashes += [digest(joined, seed)] if words else []
            counts.append(1 if words else 0)
    count = np.array(counts, dtype=np.int64)
    found = np.zeros(len(rows), dtype=np.uint64)
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1)
    own = np.flatnonzero(count)
    if len(own):
        starts = (np.cumsum(count) - count)[own]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        found[own] = np.packbits(ones * 2 > count[own, None], axis=1).view("<u8")[:, 0]
    return found


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, *also: str) -> DataFrame:
    """``key``, the columns ``also``, and ``fingerprint`` (a signed long with the 64 bits)."""
    names = ["key", *also, "fingerprint"]
    kinds = [*(df.schema[c].dataType for c in (key, *also)), T.LongType()]
    schema = T.StructType([T.StructField(n, kind) for n, kind in zip(names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches, "text"):
            found = fingerprint_texts(worker.texts(batch, "text"), shingle)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(found.view(np.int64))], names=names)

    rows = df.select(F.col(key).alias("key"), *also, F.col(text).alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def at_anchors(prints: DataFrame) -> DataFrame:
    """A row for each fingerprint and anchor within reach: ``anchor``, ``fp``, ``home``."""
    halves = prints.selectExpr(
        "fingerprint AS fp", "inline(array(struct(0L AS half, fingerprint & 4294967295 AS x), struct(1L AS half, shiftrightunsigned(fingerprint, 32) AS x)))"
    )
    masks = [sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1) for k in range(5)]
    syndrome = " | ".join(f"shiftleft(bit_count(x & {m}) & 1, {k})" for k, m in enumerate(masks))
    covered = halves.selectExpr("fp", "half", "x", f"{syndrome} AS s").selectExpr(
        "fp", "half", "x", "s", "IF(s = 0, x, x ^ shiftleft(1L, s - 1)) AS home"
    )
    two = """transform(filter(sequence(1, 31), i -> s > 0 AND i < (i ^ s) AND (i ^ s) <= 31),
        i -> struct(x ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ s) - 1) AS at, false AS home))"""
    return covered.selectExpr(
        "fp", "half", f"inline(concat(array(struct(home AS at, true AS home), struct(home ^ 2147483648 AS at, false AS home)), {two}))"
    ).selectExpr("shiftleft(half, 32) | at AS anchor", "fp", "home")


def _united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each node's is the smallest of its component) after linking ``a`` and ``b``."""
    while True:
        x, y = label[a], label[b]
        apart = np.flatnonzero(x != y)
        if not len(apart):
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _forest(group: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked within each group; rows are sorted by group, homes first."""
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.concatenate([starts, [len(group)]]))
    homes = np.add.reduceat(home.astype(np.int64), starts)
    visitors = size - homes
    left = np.flatnonzero(home)
    own = np.searchsorted(starts, left, side="right") - 1
    many, first = visitors[own], starts[own] + homes[own]
    # A home that also visits is one node.
    node = np.unique(np.stack([group, fp.astype(np.int64)], axis=1), axis=0, return_inverse=True)[1].ravel()
    label = np.arange(node.max(initial=-1) + 1)
    ends = np.cumsum(many)
    low = 0
    while low < len(left):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _PAIRS, side="right")))
        n = many[low:high]
        x = np.repeat(left[low:high], n)
        y = np.repeat(first[low:high] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        apart = np.bitwise_count(fp[x] ^ fp[y])
        near = (apart <= distance) & (apart > 0)
        label = _united(label, node[x[near]], node[y[near]])
        low = high
    value = np.zeros(len(label), dtype=fp.dtype)
    value[node] = fp
    hangs = np.flatnonzero(label != np.arange(len(label)))
    return value[label[hangs]], value[hangs]


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (``a``, ``b``) between distinct fingerprints that connect all that are within ``distance``
    bits, at most 3; not each pair of a dense group, but no connection is lost."""
    if not 0 <= distance <= 3:
        raise ValueError("anchors cover a distance of 3 bits at most")
    rows = at_anchors(prints)
    groups = rows.groupBy("anchor").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("members"))
    groups = groups.where("homes > 0 AND members > 1").selectExpr(
        "anchor", f"CAST(ceil(homes / {BLOCK}) AS INT) AS hb", f"CAST(ceil(members / {BLOCK}) AS INT) AS vb"
    )
    # The two blocks of a fingerprint must not depend on what chose its partition.
    own = "pmod(xxhash64(fp, 7), {})"
    blocks = f"""inline(concat(
        IF(home, transform(sequence(0, vb - 1), j -> struct(CAST({own.format("hb")} AS INT) AS i, j AS j, true AS home)), array()),
        transform(sequence(0, hb - 1), i -> struct(i AS i, CAST({own.format("vb")} AS INT) AS j, false AS home))))"""
    # Spark sizes what is exploded by the rows before it, so it would broadcast rows that the driver cannot hold.
    met = rows.hint("merge").join(groups, "anchor").selectExpr("anchor", "fp", blocks)
    dealt = met.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j", F.col("home").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.whole_groups(batches, ("anchor", "i", "j")):
            name = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("anchor", "i", "j")], axis=1)
            group = np.cumsum(np.concatenate([[True], (name[1:] != name[:-1]).any(axis=1)]))
            fp = batch.column("fp").to_numpy().view(np.uint64)
            a, b = _forest(group, fp, batch.column("home").to_numpy(zero_copy_only=False), distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    found = dealt.mapInArrow(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3, also: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns ``also``, ``fingerprint`` (long), ``root`` (the smallest fingerprint that links
    reach) and ``component`` (the smallest key that has one of these), a row per row."""
    prints = staged(fingerprints(df, key, text, shingle, *also), "prints")
    least = prints.groupBy("fingerprint").agg(F.min(key).alias("least"))
    roots = components(links(least.select("fingerprint"), distance))
    named = least.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = staged(named.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least"), "roots")
    component = named.groupBy("root").agg(F.min("least").alias("component"))
    of_print = named.join(component, "root").select("fingerprint", "root", "component")
    return prints.join(of_print, "fingerprint").select(key, *also, "fingerprint", "root", "component")


def one_per_group(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row, all columns, of each component: that of its smallest key, and of the texts which share that
    key the one of smallest digest.

    Rows without a key belong to no group that could name them, so all of them stay."""
    (digest,) = worker.unused(df, "digest")
    marked = df.withColumn(digest, worker.digest(text)).where(F.col(key).isNotNull())
    found = near_duplicates(marked, key, text, shingle, distance, (digest,))
    named = found.where(F.col(key) == F.col("component")).groupBy("root").agg(F.min(F.struct(key, digest)).alias("one"))
    kept = marked.join(named.select("one.*"), [key, digest], "left_semi").dropDuplicates([key, digest])
    return kept.select(*df.columns).unionByName(df.where(F.col(key).isNull()))
