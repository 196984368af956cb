"""Benchmark decontamination: a prefix-filtered set join with exact verification.

Every window of an item (``size`` consecutive words; the whole item where it is shorter) is a set of
word shingles. A document that contains the window contains each of its shingles, so the rarest one
is a sufficient prefix. Rarity is counted over all documents. Document shingles are joined with
these prefixes only; the position of the prefix in the window fixes where the window would lie, its
length must fit into the document, and the words themselves are compared last.

A bit map of fixed size, built from the benchmark, keeps document shingles that no item has out of
the shuffle; it lets some through that the join then drops, and never holds one back.

Defined results: null and empty texts have no words and no hits, and null or wordless items no
windows; items with equal windows all count; repeated documents each get their row, repeated items
count once; without documents there are no rows, without items no hits; very long texts are read
whole; columns other than the two named are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.llm import worker
from textloom.plans.session import staged

#: Words of a shingle, and bits of the map.
SHINGLE, BITS = 3, 1 << 24
_LOWER = bytes((b | 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case."""
    return text.translate(_LOWER).split()


def word_hashes(rows: list[list[bytes]]) -> np.ndarray:
    """A 64-bit hash of each word, flat."""
    distinct = {w for words in rows for w in words}
    known = {w: xxhash.xxh64_intdigest(w) for w in distinct}
    return np.fromiter((h for words in rows for h in map(known.__getitem__, words)), np.uint64, sum(map(len, rows)))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A signed hash for each position of a run of words at which so many words start."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.int64)
    mixed = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        mixed += hashes[k : len(hashes) - size + 1 + k] * _WEIGHTS[k]
    mixed ^= mixed >> np.uint64(29)
    return (mixed * _WEIGHTS[0]).view(np.int64)


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", size: int = 10) -> DataFrame:
    """Distinct windows of each item: ``item`` (the key as text), ``window`` (its words, space-joined),
    ``length`` and ``shingles`` (hash and place of each)."""
    schema = "item string, window string, length int, shingles array<struct<shingle:long, at:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches, "text"):
            out: list[dict] = []
            for item, text in zip(batch.column("item").to_pylist(), worker.texts(batch, "text")):
                words = words_of(text)
                length = min(size, len(words))
                own = shingle_hashes(word_hashes([words]), min(SHINGLE, length)).tolist() if words else []
                for i in range(len(words) - length + 1 if words else 0):
                    part = own[i : i + length - min(SHINGLE, length) + 1]
                    shingles = [{"shingle": h, "at": k} for k, h in enumerate(part)]
                    out.append({"item": item, "window": b" ".join(words[i : i + length]).decode(), "length": length, "shingles": shingles})
            if out:
                kind = pa.list_(pa.struct([("shingle", pa.int64()), ("at", pa.int32())]))
                kinds = pa.schema([("item", pa.string()), ("window", pa.string()), ("length", pa.int32()), ("shingles", kind)])
                yield pa.RecordBatch.from_pylist(out, schema=kinds)

    rows = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(run, schema).distinct()


def _map_of(shingles: DataFrame) -> np.ndarray:
    """The bit map of a column of hashes; at most ``BITS`` numbers reach the driver."""
    slots = shingles.select(F.pmod("shingle", F.lit(BITS)).cast("int").alias("slot")).distinct().toArrow()
    flags = np.zeros(BITS, dtype=np.uint8)
    flags[slots.column(0).to_numpy()] = 1
    return np.packbits(flags, bitorder="little")


def _in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & (BITS - 1)
    return np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)


def _runs(rows: list[list[bytes]], sizes: list[int], bits: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Document, places and hashes of the shingles that the map knows."""
    hashes = word_hashes(rows)
    first = np.cumsum([0, *map(len, rows)])
    for size in sizes:
        every = shingle_hashes(hashes, size)
        at = _in_map(bits, every)
        row = np.searchsorted(first, at, side="right") - 1
        inside = at + size <= first[row + 1]
        at, row = at[inside], row[inside]
        edges = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(row)]):
            yield int(row[a]), at[a:b] - first[row[a]], every[at[a:b]]


def shingle_counts(documents: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """``shingle`` and ``n``: how often shingles that the map knows occur in all documents."""
    sent = documents.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches, "text"):
            found = [h for _, _, h in _runs([words_of(t) for t in worker.texts(batch, "text")], sizes, sent.value)]
            if found:
                shingle, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(n)], names=["shingle", "n"])

    return documents.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``shingle``, ``at``, ``window`` and ``length``: each distinct window under its rarest shingle."""
    one = windows.select("window", "length", "shingles").distinct()
    each = one.select("window", "length", F.inline("shingles")).join(counts, "shingle", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "at")).alias("rarest")
    return each.groupBy("window", "length").agg(rarest).select("rarest.shingle", "rarest.at", "window", "length")


def candidates(documents: DataFrame, bits: np.ndarray, sizes: list[int], size: int) -> DataFrame:
    """A row per document: ``row``, ``key``, ``digest``, ``n_words`` and ``found``: shingle, place and the words around it."""
    sent = documents.sparkSession.sparkContext.broadcast(bits)
    kind = pa.list_(pa.struct([("shingle", pa.int64()), ("place", pa.int32()), ("before", pa.int32()), ("around", pa.string())]))
    key = documents.schema["key"].dataType.simpleString()
    schema = f"row long, key {key}, digest string, n_words long, found array<struct<shingle:long, place:int, before:int, around:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in worker.slices(batches, "text"):
            rows = [words_of(t) for t in worker.texts(batch, "text")]
            found: list[list[dict]] = [[] for _ in rows]
            for i, places, hashes in _runs(rows, sizes, sent.value):
                for place, shingle in zip(places.tolist(), hashes.tolist()):
                    low = max(0, place - size + 1)
                    around = b" ".join(rows[i][low : place + size]).decode()
                    found[i].append({"shingle": shingle, "place": place, "before": place - low, "around": around})
            numbers = pa.array(np.arange(row, row + len(rows)))
            row += len(rows)
            counts = pa.array([len(words) for words in rows], pa.int64())
            columns = [numbers, batch.column("key"), batch.column("digest"), counts, pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "key", "digest", "n_words", "found"])

    return documents.mapInArrow(run, schema)


def contamination(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", size: int = 10,
) -> DataFrame:
    """Per document: ``key``, ``digest`` of the text, ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``items``
    (keys as sorted text of the items with such windows) and ``contaminated``."""
    documents = documents.select(F.col(key).alias("key"), worker.digest(text).alias("digest"), F.col(text).alias("text"))
    windows = staged(item_windows(items, item_key, item_text, size), "windows")
    every = windows.select(F.explode("shingles.shingle").alias("shingle"))
    sizes = sorted(r[0] for r in windows.select(F.least("length", F.lit(SHINGLE))).distinct().collect())
    counts = shingle_counts(documents, _map_of(every), sizes)
    wanted = staged(prefixes(windows, counts), "prefixes")
    found = staged(candidates(documents, _map_of(wanted), sizes, size), "candidates")
    near = found.select("row", "n_words", F.inline("found")).join(wanted, "shingle")
    start = F.col("place") - F.col("at")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words")) & (F.col("at") <= F.col("before"))
    there = F.array_join(F.slice(F.split("around", " "), F.col("before") - F.col("at") + 1, F.col("length")), " ")
    hits = near.where(fits).where(there == F.col("window")).select("row", start.alias("start"), "length", "window")
    hits = staged(hits, "hits")
    before = W.partitionBy("row").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    spans = hits.select("row", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    n_hit = spans.withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit"))
    met = hits.select("row", "window").distinct().join(windows.select("window", "item"), "window").select("row", "item")
    of_row = met.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    result = found.select("row", "key", "digest", "n_words").join(n_hit, "row", "left").join(of_row, "row", "left")
    return result.select(
        F.col("key").alias(key), "digest", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def without_contaminated(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, all columns, without a hit. Hits belong to a key and a text, so of rows that share a key,
    null too, only the contaminated ones go."""
    own_key, digest = worker.unused(documents, "key", "digest")
    hit = contamination(documents, items, key, text).where("contaminated").select(F.col(key).alias(own_key), F.col("digest").alias(digest))
    same = F.col(key).eqNullSafe(F.col(own_key)) & (worker.digest(text) == F.col(digest))
    return documents.join(hit.distinct(), same, "left_anti")
