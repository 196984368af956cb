"""Quality rules by host: rule failures per host, shrunk towards the hosts' common rate, decide for all its documents.

Each document gets its own counts, the base rules and three more: too many symbols, too many repeated lines,
words of no usual length. Failures are added up by host and rule, combined before the shuffle. For each rule
a beta distribution is fitted to the hosts' failure rates by moments that weigh hosts by their documents and
leave out what sampling alone makes rates vary; its two parameters count as so many failures and passes
seen at every host beforehand, so that a host with few documents is judged by the common rate and one with
many by its own. A host fails a rule if its shrunk rate lies beyond what the fitted distribution explains and
above ``FLOOR``, or reaches ``HOST_LIMIT`` in any case. A host that fails a rule fails with all its documents.

Defined results: a null or empty text has no words and fails; documents without a host share one; a
rate of zero or one over all hosts, hosts that vary no more than samples do, or a single host, get the
strongest prior; repeated rows count and are returned as often as they come; an empty table gives no rows;
texts of any length are counted whole; columns other than those named are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import worker
from textloom.plans.session import staged

#: Words that a document needs, percent of repeated words that it may have, words of a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
#: Shrunk failure rate at which a host fails in any case, the least at which it can fail, deviations of the
#: fitted distribution beyond which it does, and the bounds of the distribution's strength.
HOST_LIMIT, FLOOR, DEVIATIONS, WEAKEST, STRONGEST = 0.5, 0.3, 3.0, 1.0, 10_000.0
#: Rules beside the base one: percent of symbols and of repeated lines, shortest and longest mean of words.
MOST_SYMBOLS, MOST_LINES, SHORTEST, LONGEST = 10, 30, 2, 15
RULES = ("base", "symbols", "lines", "words")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_NO_WORD = bytes([*range(0x80, 0xC0), 0x20, *range(0x09, 0x0E)])
_SYMBOLS = b"#*$%&|<>"


def repeated_words(rows: list[list[bytes]]) -> np.ndarray:
    """Per text, the words inside windows that the text has twice or more; windows are compared exactly."""
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    code: dict[bytes, int] = {w: i for i, w in enumerate({w for words in rows for w in words})}
    word = np.fromiter((c for words in rows for c in map(code.__getitem__, words)), np.int64, int(size.sum()))
    n = len(word) - WINDOW + 1
    if n < 2:
        return np.zeros(len(rows), dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), size)
    whole = np.flatnonzero(row[:n] == row[WINDOW - 1 :])
    mixed = row[whole].astype(np.uint64)
    for k in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + word[whole + k].astype(np.uint64)
        mixed ^= mixed >> np.uint64(31)
    order = whole[np.argsort(mixed, kind="stable")]
    columns = [row[order], *(word[order + k] for k in range(WINDOW))]
    same = np.all([c[1:] == c[:-1] for c in columns], axis=0)
    sorted_hash = np.sort(mixed)
    if ((sorted_hash[1:] == sorted_hash[:-1]) & ~same).any():
        order = whole[np.lexsort([row[whole], *(word[whole + k] for k in range(WINDOW))])]
        columns = [row[order], *(word[order + k] for k in range(WINDOW))]
        same = np.all([c[1:] == c[:-1] for c in columns], axis=0)
    twice = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    edge = np.zeros(len(word) + 1, dtype=np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return np.bincount(row, weights=np.cumsum(edge[:-1]) > 0, minlength=len(rows)).astype(np.int64)


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that are equal to an earlier one."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len({*lines})


def counts(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``key``, ``host``, the counts of the whole text and ``base_failed``."""
    fields = [T.StructField("key", df.schema[key].dataType), T.StructField("host", df.schema[host].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in _COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches, "text"):
            rows = worker.texts(batch, "text")
            words = [text.split() for text in rows]
            lines, repeated = zip(*map(_lines, rows))
            found = (
                [len(w) for w in words], [len(t.translate(None, _NO_WORD)) for t in rows],
                [len(t) - len(t.translate(None, _SYMBOLS)) for t in rows], lines, repeated, repeated_words(words),
            )
            columns = [batch.column("key"), batch.column("host"), *(pa.array(c, pa.int64()) for c in found)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    rows = df.select(F.col(key).alias("key"), F.col(host).alias("host"), F.col(text).alias("text"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.mapInArrow(run, T.StructType(fields)).withColumn("base_failed", failed)


def failures() -> dict[str, Column]:
    """Whether a document with these counts fails each rule."""
    chars, words = F.col("word_chars"), F.col("n_words")
    return {
        "base": F.col("base_failed"),
        "symbols": 100 * F.col("n_symbols") > MOST_SYMBOLS * chars,
        "lines": 100 * F.col("n_dup_lines") > MOST_LINES * F.col("n_lines"),
        "words": (chars < SHORTEST * words) | (chars > LONGEST * words),
    }


@dataclass(frozen=True)
class Prior:
    """Mean and strength of a beta distribution of failure rates."""

    mean: float
    strength: float

    @property
    def limit(self) -> float:
        """The shrunk rate from which a host fails."""
        deviation = (self.mean * (1 - self.mean) / (self.strength + 1)) ** 0.5
        return min(HOST_LIMIT, max(FLOOR, self.mean + DEVIATIONS * deviation))


def fit_prior(hosts: int, n: float, squares: float, failed: float, by_rate: float) -> Prior:
    """The prior of a rule from sums over hosts: of documents, their squares, failures, and failures times the host's rate.

    The weighted variance of the rates is what sampling makes of a common rate, plus the correlation of documents
    of a host times what full correlation would give; the strength follows from that correlation."""
    mean = failed / n if n else 0.0
    spread = mean * (1 - mean)
    room = n - squares / n - (hosts - 1) if n else 0.0
    if spread <= 0 or room <= 0:
        return Prior(mean, STRONGEST)
    correlation = ((by_rate - mean * failed) / spread - (hosts - 1)) / room
    return Prior(mean, STRONGEST if correlation <= 0 else min(STRONGEST, max(WEAKEST, 1 / correlation - 1)))


def host_rates(counted: DataFrame) -> tuple[DataFrame, dict[str, Prior]]:
    """``host``, ``n``, failures and the shrunk rate ``rate_<rule>`` by rule, and ``host_failed``; and the priors."""
    sums = [F.sum(failed.cast("long")).alias(rule) for rule, failed in failures().items()]
    hosts = staged(counted.groupBy("host").agg(F.count("*").alias("n"), *sums), "hosts")
    n = F.col("n").cast("double")
    moments = hosts.agg(
        F.count("*"), F.sum(n), F.sum(n * n), *(F.sum(F.col(rule).cast("double")) for rule in RULES), *(F.sum(F.col(rule) * (F.col(rule) / n)) for rule in RULES)
    ).first()
    many, n_all, squares, *rest = [x or 0 for x in moments]
    priors = {rule: fit_prior(many, n_all, squares, *two) for rule, *two in zip(RULES, rest[: len(RULES)], rest[len(RULES) :])}
    rates = {f"rate_{rule}": (F.col(rule) + F.lit(p.mean * p.strength)) / (F.col("n") + F.lit(p.strength)) for rule, p in priors.items()}
    failed = F.lit(False)
    for rule, prior in priors.items():
        failed = failed | (F.col(f"rate_{rule}") >= F.lit(prior.limit))
    return hosts.withColumns(rates).withColumn("host_failed", failed), priors


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """A row per document: ``key``, ``host``, the counts, ``base_failed``, ``host_failed`` and ``kept``."""
    counted = staged(counts(df, key, text, host), "counts")
    verdicts = host_rates(counted)[0].select(F.col("host").alias("judged"), "host_failed")
    both = counted.join(verdicts, F.col("host").eqNullSafe(F.col("judged"))).drop("judged")
    return both.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")).withColumnRenamed("key", key)
