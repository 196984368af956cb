"""The most frequent terms of a corpus by bounded summaries.

Counting every word pair of a corpus moves its long tail through a shuffle, only to drop it. Here each
task keeps a Misra-Gries summary: when it holds too many terms, the count that would leave ``keep`` of
them is taken off all, and what reaches zero goes. What a task has taken off is the most by which it can
be wrong about any term, so summaries add up: a term's true count lies between the sum of its counts
and that sum plus all errors. With the k-th largest sum as bar, no term whose sum stays below
the bar less the error can be among the k most frequent, whether it is in a summary or not. The others
are counted exactly in a second pass, in which tasks count nothing else.

A task whose terms all fit takes nothing off; if none does, the sums are exact and one pass is enough. If
the errors reach the bar, the summaries are made again with more room, so the result is always exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.session import staged

#: Terms that a summary keeps for each that is asked for.
KEEP = 16
_ONE = np.int64(1 << 32)


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, with their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], *(np.add.reduceat(c[order], starts) if len(starts) else c for c in counts)


def batch_counts(codes: np.ndarray, sizes: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of some documents as keys, with occurrences and documents.

    ``codes`` are the words, -1 for one that no term of interest has. A key is a word's code, or of a pair
    the codes of both, the first one plus one in the upper half.
    """
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    parts = []
    if low == 1:
        at = np.flatnonzero(codes >= 0)
        parts.append((row[at], codes[at]))
    if high == 2:
        at = np.flatnonzero((row[:-1] == row[1:]) & (codes[:-1] >= 0) & (codes[1:] >= 0))
        parts.append((row[at], (codes[at] + 1) * _ONE + codes[at + 1]))
    row, key = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    keys, place = np.unique(key, return_inverse=True)
    own, n = np.unique(row * np.int64(max(1, len(keys))) + place, return_counts=True)
    place = own % max(1, len(keys))
    total = np.bincount(place, weights=n, minlength=len(keys)).astype(np.int64)
    return keys, total, np.bincount(place, minlength=len(keys)).astype(np.int64)


class Summary:
    """Counts of a task's terms: of all, or of those that are left after taking ``error`` off each."""

    def __init__(self, keep: int):
        self.keep, self.error, self.documents = keep, 0, 0
        self.words: dict[str, int] = {}
        self.held = [tuple(np.zeros(0, np.int64) for _ in range(3))]
        self.size = 0

    def add(self, words: pa.Array, low: int, high: int) -> None:
        """Take in documents as lists of words."""
        coded = pc.dictionary_encode(words.flatten())
        own = np.fromiter((self.words.setdefault(w, len(self.words)) for w in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        codes = own[coded.indices.to_numpy()] if len(own) else np.zeros(0, np.int64)
        sizes = pc.fill_null(words.value_lengths(), 0).to_numpy(zero_copy_only=False)
        self.documents += len(sizes)
        self.held.append(batch_counts(codes, sizes, low, high))
        self.size += len(self.held[-1][0])
        if self.size > 4 * self.keep:
            self.merge()

    def merge(self) -> None:
        keys, n, docs = summed(*(np.concatenate([h[i] for h in self.held]) for i in range(3)))
        if len(keys) > 2 * self.keep:
            # The largest count that does not stay.
            off = int(np.partition(n, len(n) - self.keep - 1)[len(n) - self.keep - 1])
            stay = n > off
            keys, n, docs, self.error = keys[stay], n[stay] - off, docs[stay], self.error + off
        self.held, self.size = [(keys, n, docs)], len(keys)
        if len(self.words) > 8 * self.keep:
            used = np.unique(np.concatenate([keys % _ONE, (keys // _ONE - 1)[keys >= _ONE]]))
            new = np.zeros(len(self.words), np.int64)
            new[used] = np.arange(len(used))
            names = [*self.words]
            self.words = {names[i]: at for at, i in enumerate(used.tolist())}
            keys = np.where(keys >= _ONE, (new[keys // _ONE - 1] + 1) * _ONE, 0) + new[keys % _ONE]
            self.held = [summed(keys, n, docs)]

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Terms with counts; the row of the null term has the documents and the error."""
        self.merge()
        names = ["term", "n", "docs", "error"]
        (keys, n, docs), words = self.held[0], pa.array([*self.words], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), *(pa.array([x], pa.int64()) for x in (0, self.documents, self.error))], names=names)
        for part in (keys < _ONE, keys >= _ONE):
            for at in np.array_split(np.flatnonzero(part), max(1, np.count_nonzero(part) >> 16)):
                if len(at):
                    term = words.take(pa.array(keys[at] % _ONE))
                    if keys[at[0]] >= _ONE:
                        term = pc.binary_join_element_wise(words.take(pa.array(keys[at] // _ONE - 1)), term, " ")
                    yield pa.RecordBatch.from_arrays([term, pa.array(n[at]), pa.array(docs[at]), pa.array(np.zeros(len(at), np.int64))], names=names)


_SCHEMA = "term string, n long, docs long, error long"


def summaries(words: DataFrame, keep: int, low: int, high: int) -> DataFrame:
    """The summaries of all tasks over a frame of one column, the documents' words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(keep)
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                summary.add(batch.column(0).slice(first, 1024), low, high)
        yield from summary.batches()

    return words.mapInArrow(run, _SCHEMA)


def exact_counts(words: DataFrame, terms: list[str], low: int, high: int) -> DataFrame:
    """Occurrences and documents of the given terms; the row of the null term counts all documents."""
    split = [term.split(" ") for term in terms]
    known = pa.array(sorted({word for parts in split for word in parts}), pa.string())
    place = {word: at for at, word in enumerate(known.to_pylist())}
    key_of = {(place[p[0]] + 1) * int(_ONE) + place[p[1]] if len(p) == 2 else place[p[0]]: term for p, term in zip(split, terms)}
    sent = words.sparkSession.sparkContext.broadcast((known, key_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, key_of = sent.value
        wanted = np.array(sorted(key_of), dtype=np.int64)
        n, docs, documents = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64), 0
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                lists = batch.column(0).slice(first, 1024)
                codes = pc.fill_null(pc.index_in(lists.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                keys, total, of = batch_counts(codes, pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False), low, high)
                at = np.minimum(np.searchsorted(wanted, keys), max(0, len(wanted) - 1))
                own = wanted[at] == keys if len(wanted) else np.zeros(len(keys), bool)
                n[at[own]] += total[own]
                docs[at[own]] += of[own]
                documents += len(lists)
        found = np.flatnonzero(n)
        columns = [[None, *(key_of[k] for k in wanted[found].tolist())], [0, *n[found].tolist()], [documents, *docs[found].tolist()], [0] * (len(found) + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), *[pa.int64()] * 3))], names=["term", "n", "docs", "error"])

    return words.mapInArrow(run, _SCHEMA)


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.sum("error").alias("error"))


def most_frequent(words: DataFrame, limit: int, low: int = 1, high: int = 2, keep: int | None = None) -> DataFrame:
    """``term``, ``n`` and ``docs``: the null term with the documents, then the ``limit`` terms that occur most often; ties in
    alphabetical order. ``words`` has one column, the words of each document; terms are words, pairs, or both."""
    if not 1 <= low <= high <= 2:
        raise ValueError("terms are words or pairs of them")
    keep = keep or KEEP * limit
    while True:
        sums = staged(_totals(summaries(words, keep, low, high)), "heavy")
        error = sums.where("term IS NULL").agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
        if not error:
            counts = sums
            break
        top = sums.where("term IS NOT NULL").orderBy(F.desc("n")).limit(limit).agg(F.min("n"), F.count("*")).first()
        # Fewer terms than asked for leave no bar.
        bar = (top[0] if top[1] == limit else 0) - error
        if bar > 0:
            likely = sums.where((F.col("n") >= bar) & F.col("term").isNotNull())
            # Not more than the summaries of one task hold, else they are made again with more room.
            terms = [row.term for row in likely.select("term").limit(keep + 1).collect()]
            if len(terms) <= keep:
                counts = _totals(exact_counts(words, terms, low, high))
                break
        keep *= 8
    return counts.orderBy(F.col("term").isNotNull(), F.desc("n"), "term").limit(limit + 1).select("term", "n", "docs")
