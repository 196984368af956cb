"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its distinct words, pairs of neighbours and pairs with one word between,
hashed into a fixed space. Each coordinate has its own learning rate, and the L1 term keeps nearly
all weights at exactly zero, so that the model is a short list, bounded by the hash space, which
every task holds. Learning is sequential by nature, so all labelled documents are dealt by a hash to as many
learners as it takes for each to have ``MOST_ROWS`` on average (a parameter of :func:`train`); each learner
goes through its documents in one task, and the mean of their weights is the model: a score's logit is the mean of the learners'
logits. Learners that know fewer rows hold fewer weights, and the mean of many is the nearer to zero, so slope and intercept of
the mean are fitted afterwards (Platt's way), on what the learners that have not seen a document say of it. Scoring is one pass
without a shuffle.

Defined results: a null or empty text has no features and gets the score of the bias alone; labels
that are null are left out, a document labelled more than once counts as its largest label, labels
without a document are ignored; without any labels of both kinds all scores are 0; repeated rows are
scored each; an empty table gives no rows; only the named columns are read, and a score depends on
nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import worker
from textloom.llm.decontaminate import word_hashes, words_of
from textloom.plans.session import staged

#: Size of the hash space (a power of two), and the labelled rows of a learner.
SPACE, MOST_ROWS = 1 << 22, 12_000
#: Logits are fitted in steps of this size, up to this size.
STEP, FAR = 1 / 64, 40.0
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@dataclass(frozen=True)
class Settings:
    """Learning rate, its smoothing, the two penalties, the rows a coordinate needs, and the passes."""

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 1.2
    l2: float = 0.1
    least_rows: int = 4
    passes: int = 6


@dataclass(frozen=True)
class Model:
    """The weights that are not zero; coordinate ``SPACE`` is the bias."""

    at: np.ndarray
    weight: np.ndarray


def features(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Row and coordinate of every feature occurrence of the texts."""
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    row = np.repeat(np.arange(len(rows)), size)
    word = word_hashes(rows)
    parts = [(row, word)]
    for gap, mix in ((1, _MIX[0]), (2, _MIX[1])):
        inside = np.flatnonzero(row[:-gap] == row[gap:])
        both = word[inside] * mix + word[inside + gap]
        parts.append((row[inside], both ^ (both >> np.uint64(32)) + np.uint64(gap)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([(p[1] >> np.uint64(20)) & np.uint64(SPACE - 1) for p in parts]).astype(np.int64)


def distinct_features(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, coordinate), by row."""
    row, at = features(rows)
    both = np.unique(row * SPACE + at)
    return both // SPACE, both % SPACE


def ftrl(rows: list[np.ndarray], labels: np.ndarray, settings: Settings) -> Model:
    """Learn from rows of distinct coordinates in the given order.

    The L1 penalty of a coordinate grows with the root of the number of rows that have it, as does
    what it gathers by chance; coordinates of fewer than ``least_rows`` rows are left out.
    """
    seen = np.zeros(SPACE + 1, dtype=np.int32)
    for at in rows:
        seen[at] += 1
    # Only coordinates that are learned from get a place.
    used = np.append(np.flatnonzero(seen[:SPACE] >= settings.least_rows), SPACE)
    place = np.full(SPACE + 1, -1, dtype=np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    z, n, least = np.zeros(len(used)), np.zeros(len(used)), settings.l1 * np.sqrt(seen[used])
    a, b, l2 = settings.alpha, settings.beta, settings.l2
    rows = [np.append((own := place[at])[own >= 0], place[SPACE:]) for at in rows]

    def weights(at: np.ndarray, zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return -np.sign(zs) * np.maximum(np.abs(zs) - least[at], 0) / ((b + np.sqrt(ns)) / a + l2)

    for _ in range(settings.passes):
        for at, label in zip(rows, labels):
            zs, ns = z[at], n[at]
            w = weights(at, zs, ns)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / a * w
            n[at] = ns + g * g
    kept = np.flatnonzero((np.abs(z) > least) | (used == SPACE))
    return Model(used[kept], weights(kept, z[kept], n[kept]))


def train(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    most_rows: int = MOST_ROWS, settings: Settings = Settings(),
) -> Model:
    """Fit on all labelled documents, ``most_rows`` of them to a learner; more than one learner's mean is fitted to the labels once more."""
    order = F.xxhash64(F.col("key").cast("string"))
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label")).dropna()
    # Labels without a document don't count.
    known = known.join(documents.select(F.col(key).alias("key")), "key", "left_semi")
    known = staged(known.groupBy("key").agg(F.max("label").alias("label")), "labels")
    n, low, high = known.agg(F.count("*"), F.min("label"), F.max("label")).first()
    if not n or low == high:
        return Model(np.array([SPACE]), np.array([-np.inf]))
    learners = -(-n // most_rows)
    # One shuffle: the partitions in which documents meet their labels are the learners.
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).repartition(learners, "key").join(known.repartition(learners, "key"), "key")
    kind = documents.schema[key].dataType.simpleString()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: list[np.ndarray] = []
        keys: list[pa.Array] = []
        place: list[int] = []
        labels: list[float] = []
        for batch in worker.slices(batches, "text"):
            words = [words_of(t) for t in worker.texts(batch, "text")]
            row, own = distinct_features(words)
            at += np.split(own.astype(np.int32), np.cumsum(np.bincount(row, minlength=len(words)))[:-1])
            keys.append(batch.column("key"))
            place += batch.column("place").to_pylist()
            labels += batch.column("label").to_pylist()
        if at:
            turn = sorted(range(len(at)), key=lambda i: (place[i], labels[i], at[i].astype(">i4").tobytes()))
            model = ftrl([at[i] for i in turn], np.array([labels[i] for i in turn]), settings)
            names = ["at", "weight", "key", "own"]
            none = [pa.nulls(len(model.at), kind) for kind in (keys[0].type, pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(model.at, pa.int32()), pa.array(model.weight), *none], names=names)
            dense = np.zeros(SPACE + 1)
            dense[model.at] = model.weight
            own = pa.array([float(dense[i].sum() + dense[SPACE]) for i in at])
            keys = pa.chunked_array(keys).combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.nulls(len(own), pa.int32()), pa.nulls(len(own), pa.float64()), keys, own], names=names)

    dealt = rows.select("key", F.xxhash64(F.col("key").cast("string")).alias("place"), "label", "text")
    learned = staged(dealt.mapInArrow(learn, f"at int, weight double, key {kind}, own double"), "learned")
    # Every learner has a bias; the sums are bounded by the hash space.
    total = learned.where("at IS NOT NULL").groupBy("at").agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).orderBy("at").toArrow()
    at, weight, n = (total.column(c).to_numpy() for c in ("at", "weight", "n"))
    mean, met = Model(at, weight / n[-1]), int(n[-1])
    if met < 2:
        return mean
    # A row per document: its label and the mean of the learners that have not seen it.
    seen = learned.where("at IS NULL").groupBy("key").agg(F.avg("own").alias("own"))
    every = logits(documents, mean, key, text).select(F.col(key).alias("key"), "logit").groupBy("key").agg(F.avg("logit").alias("every"))
    others = (F.col("every") * met - F.col("own")) / (met - 1)
    step = F.round(F.least(F.greatest(others, F.lit(-FAR)), F.lit(FAR)) / STEP).cast("int")
    steps = known.join(seen, "key").join(every, "key").groupBy(step.alias("step")).agg(F.sum("label").alias("hits"), F.count("*").alias("rows"))
    found = steps.orderBy("step").toArrow()
    slope, intercept = platt(*(found.column(c).to_numpy().astype(np.float64) for c in ("step", "hits", "rows")))
    weight = mean.weight * slope
    weight[mean.at == SPACE] += intercept
    return Model(mean.at, weight)


def platt(step: np.ndarray, hits: np.ndarray, rows: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logits ``step * STEP`` with the largest likelihood, by Newton's method; ``hits`` of ``rows`` have label 1.

    Either label counts as if two more rows were known, one of each label, so that the slope stays finite. A slope below
    zero would turn the order round: nothing is changed then."""
    x, n1 = step * STEP, hits.sum()
    n0 = rows.sum() - n1
    target = hits * (n1 + 1) / (n1 + 2) + (rows - hits) / (n0 + 2)

    def loss(point: np.ndarray) -> float:
        z = point[0] * x + point[1]
        return float((rows * np.logaddexp(0, z) - target * z).sum())

    point = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(point[0] * x + point[1], -500, 500)))
        error, bend = rows * p - target, rows * p * (1 - p)
        gradient = np.array([error @ x, error.sum()])
        curve = np.array([[bend @ (x * x) + 1e-9, bend @ x], [bend @ x, bend.sum() + 1e-9]])
        move, size, now = np.linalg.solve(curve, gradient), 1.0, loss(point)
        while size > 1e-9 and loss(point - size * move) > now - 1e-4 * size * (gradient @ move):
            size /= 2
        if size <= 1e-9 or np.abs(size * move).max() < 1e-9:
            break
        point = point - size * move
    return (float(point[0]), float(point[1])) if point[0] > 0 else (1.0, 0.0)


def _scorer(documents: DataFrame, model: Model):
    """A function that gives, inside tasks, the logits of texts."""
    sent = documents.sparkSession.sparkContext.broadcast((model.at, model.weight))

    def found(rows: list[bytes]) -> np.ndarray:
        at, weight = sent.value
        dense = np.zeros(SPACE, dtype=np.float64)
        dense[at[at < SPACE]] = weight[at < SPACE]
        words = [words_of(t) for t in rows]
        row, used = features(words)
        live = np.flatnonzero(dense[used])
        both = np.unique(row[live] * SPACE + used[live])
        return float(weight[at == SPACE].sum()) + np.bincount(both // SPACE, weights=dense[both % SPACE], minlength=len(words))

    return found


def _chance(logit: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-logit))


def logits(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``logit`` of every row."""
    found = _scorer(documents, model)
    schema = T.StructType([T.StructField("key", documents.schema[key].dataType), T.StructField("logit", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found(worker.texts(batch, "text")))], names=["key", "logit"])

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score``, the probability of label 1."""
    logits_of = _scorer(documents, model)
    schema = T.StructType([T.StructField("key", documents.schema[key].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches, "text"):
            found = pa.array(_chance(logits_of(worker.texts(batch, "text"))))
            yield pa.RecordBatch.from_arrays([batch.column("key"), found], names=["key", "score"])

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def without_toxic(documents: DataFrame, model: Model, text: str = "text", limit: float = 0.7) -> DataFrame:
    """The rows, all columns, whose score stays below the limit; no shuffle."""
    logits_of = _scorer(documents, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches, text):
            yield batch.filter(pa.array(_chance(logits_of(worker.texts(batch, text))) < limit))

    return documents.mapInArrow(run, documents.schema)


def held_out(key: str = "doc_id"):
    """Whether a document's label is kept from the learner: the crc32 of its key leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
