"""Automatic labels, review split, agreement and merging of human corrections."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import patterns as P
from textloom.functions.numbers import count_where, pct, to_double
from textloom.functions.text import ngrams, strip
from textloom.operators import prepare
from textloom.operators.frames import as_map, side_by_side
from textloom.plans.session import small_side

log = logging.getLogger(__name__)

# The default classes and their keywords.
DEFAULT_KEYWORDS = {
    "navigation": ["route planning", "waypoint", "chartplotter", "tide", "course"],
    "safety": ["life jacket", "colregs", "man overboard", "distress", "watchkeeping"],
    "equipment": ["rigging", "anchor", "engine", "electronics", "maintenance"],
    "weather": ["forecast", "wind", "storm", "barometer", "sea state"],
    "licensing": ["regulation", "certificate", "compliance", "exam", "radio license"],
}
# Fixed values.
CONFIDENCE_THRESHOLD = 0.7
BATCH_SIZE = 16

_WORDS = re.compile(r"\w+")

Scorer = Callable[[list[str], list[str]], list[tuple[str, float]]]


def candidate_labels(classes: Sequence[str], review_label: str = prepare.REVIEW_LABEL) -> list[str]:
    """Classes plus the review class, stripped, distinct, in order."""
    stripped = (str(name).strip() for name in [*classes, review_label])
    return list(dict.fromkeys(name for name in stripped if name))


def keyword_hits(tokens: Column, keywords: Sequence[str]) -> Column:
    """Whole-word, case-insensitive occurrences of the keywords among the lower-case words.

    A keyword of several words counts where its words follow each other.
    """
    phrases: dict[int, set[str]] = {}
    for keyword in keywords:
        words = _WORDS.findall(keyword.lower())
        if words:
            phrases.setdefault(len(words), set()).add(" ".join(words))
    hits = F.lit(0)
    for length, wanted in sorted(phrases.items()):
        hits = hits + F.size(F.filter(ngrams(tokens, length, length), lambda gram: gram.isin(sorted(wanted))))
    return hits


def auto_label(
    df: DataFrame,
    keywords: Mapping[str, Sequence[str]] = DEFAULT_KEYWORDS,
    review_label: str = prepare.REVIEW_LABEL,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Label rows by keyword hits, as column expressions only.

    The class with most hits wins, earlier classes win ties; the confidence is its share of all
    hits. A text without hits goes to the review class.
    """
    df = prepare.prepare_annotation(df, order_by)
    names = list(keywords)
    hits = F.array(*[keyword_hits(F.col("_words"), keywords[name]) for name in names])
    best = F.array_max("_hits")
    total = F.aggregate("_hits", F.lit(0), lambda left, right: left + right)
    found = best > 0
    winner = F.element_at(F.array(*[F.lit(name) for name in names]), F.array_position("_hits", best).cast("int"))
    return (
        df.withColumn("_words", F.regexp_extract_all(F.lower("text"), F.lit(f"{P.WORD}+"), F.lit(0)))
        .withColumn("_hits", hits)
        .withColumns(
            {
                "label": F.when(found, winner).otherwise(F.lit(review_label)),
                "confidence": F.when(found, F.round(best / total, 6)).otherwise(F.lit(0.0)),
                "label_source": F.when(found, F.lit("keyword")).otherwise(F.lit(prepare.FALLBACK)),
            }
        )
        .drop("_words", "_hits")
    )


def auto_label_with(
    df: DataFrame,
    scorer: Scorer | Callable[[], Scorer] | None,
    classes: Sequence[str] = tuple(DEFAULT_KEYWORDS),
    review_label: str = prepare.REVIEW_LABEL,
    label_source: str = "zero_shot",
    batch_size: int = BATCH_SIZE,
    lazy: bool = False,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Label rows with any scorer, in batches; ``None`` sends every row to review.

    A scorer gets the texts of one batch and the candidate labels and returns one (label,
    score) pair per text. With ``lazy`` it is a factory, called once per task, for scorers that
    load a model. A batch whose scorer fails falls back to the review class.
    """
    df = prepare.prepare_annotation(df, order_by)
    if scorer is None:
        return df.withColumns(
            {
                "label": F.lit(review_label),
                "confidence": F.lit(0.0),
                "label_source": F.lit(prepare.FALLBACK),
            }
        )
    labels = candidate_labels(classes, review_label)
    base = df.drop("label", "confidence", "label_source")
    schema = T.StructType(
        [*base.schema.fields]
        + [
            T.StructField("label", T.StringType()),
            T.StructField("confidence", T.DoubleType()),
            T.StructField("label_source", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _with_scores(batches, scorer() if lazy else scorer, labels, review_label, label_source, batch_size)

    return base.mapInArrow(run, schema)


def _with_scores(
    batches: Iterator[pa.RecordBatch], score: Scorer, labels: list[str], review_label: str, label_source: str, batch_size: int
) -> Iterator[pa.RecordBatch]:
    """The batches with label, confidence and label source; only one batch of the scorer is held as Python strings."""
    for batch in batches:
        rows: list[tuple[str, float, str]] = []
        for start in range(0, batch.num_rows, batch_size):
            texts = batch.column("text").slice(start, batch_size).to_pylist()
            try:
                scored = score(texts, labels)
                if len(scored) != len(texts):
                    raise ValueError(f"scorer returned {len(scored)} results for {len(texts)} texts")
                rows += [
                    (str(label or "").strip() or review_label, round(float(value), 6), label_source)
                    for label, value in scored
                ]
            except Exception as error:  # any scorer may fail in its own way
                log.warning("scorer failed, batch goes to review: %s", error)
                rows += [(review_label, 0.0, prepare.FALLBACK)] * len(texts)
        own = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.string()))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, "label", "confidence", "label_source"])


def split_by_confidence(
    df: DataFrame, threshold: float = CONFIDENCE_THRESHOLD, review_label: str = prepare.REVIEW_LABEL
) -> tuple[DataFrame, DataFrame]:
    """Confident rows, and the rest for review."""
    df = prepare.prepare_labeled(df, review_label)
    confident = F.col("confidence") >= threshold
    return df.where(confident), df.where(~confident)


def is_corrected(strip_first: bool = False) -> Column:
    """Does the queue row carry a correction? White space counts unless ``strip_first``."""
    correction = F.coalesce(F.col("corrected_label"), F.lit(""))
    return (strip(correction) if strip_first else correction) != ""


def annotation_quality(
    df: DataFrame,
    threshold: float = CONFIDENCE_THRESHOLD,
    review_label: str = prepare.REVIEW_LABEL,
    queue: DataFrame | None = None,
) -> DataFrame:
    """Annotation report as one row; with a review queue it includes the agreement."""
    # One pass: everything below derives from one row per label and label source.
    confidence = F.col("confidence")
    groups = small_side(
        prepare.prepare_labeled(df, review_label).groupBy("label", "label_source").agg(
            F.count("*").alias("rows"),
            F.avg(confidence).alias("_mean"),
            F.var_pop(confidence).alias("_variance"),
            count_where(confidence < threshold).alias("_low"),
        )
    )
    rows = F.sum("rows")
    total, low = F.coalesce(rows, F.lit(0)), F.coalesce(F.sum("_low"), F.lit(0))
    # Counts, means and variances of the groups merge without a difference of large squares.
    mean = F.sum(F.col("_mean") * F.col("rows")) / rows
    whole = groups.agg(mean.alias("mean")).scalar()
    apart = F.col("_variance") + (F.col("_mean") - whole) * (F.col("_mean") - whole)
    spread = F.sqrt(F.sum(F.col("rows") * apart) / rows)
    parts = [
        groups.agg(
            total.alias("total_labeled"),
            F.coalesce(F.round(mean, 4), F.lit(0.0)).alias("confidence_mean"),
            F.coalesce(F.round(spread, 4), F.lit(0.0)).alias("confidence_std"),
            low.alias("low_confidence_count"),
            pct(low, total).alias("low_confidence_pct"),
            (total - low).alias("high_confidence_count"),
            F.coalesce(F.sum(F.when(F.col("label") == review_label, F.col("rows"))), F.lit(0)).alias("review_label_count"),
        )
    ]
    for column in ("label", "label_source"):
        counts = groups.groupBy(column).agg(F.sum("rows").alias("rows"))
        parts.append(as_map(counts, column, "rows", f"{column}_distribution"))
    if queue is not None:
        parts.append(kappa(df, queue))
    return side_by_side(parts)


def agreement_counts(annotated: DataFrame, queue: DataFrame) -> DataFrame:
    """Rows per (automatic label, correction) over corrected queue rows with a known id.

    Ids may repeat on either side. Both sides are reduced to one row per id (and label pair)
    first, and the multiplicities are multiplied, so a repeated id never multiplies rows.
    """
    corrected = (
        queue.where(is_corrected())
        .groupBy(F.col("id").cast("string").alias("id"), "label", "corrected_label")
        .agg(F.count("*").alias("_reviews"))
    )
    known = annotated.groupBy(F.col("id").cast("string").alias("id")).agg(F.count("*").alias("_rows"))
    return (
        corrected.join(known, "id")
        .groupBy("label", "corrected_label")
        .agg(F.sum(F.col("_reviews") * F.col("_rows")).alias("rows"))
    )


def kappa(annotated: DataFrame, queue: DataFrame) -> DataFrame:
    """Cohen's kappa between automatic labels and corrections, as one row.

    Null below two joined rows, and where chance agreement is perfect.
    """
    counts = small_side(agreement_counts(annotated, queue))
    sides = counts.select(F.col("label").alias("name"), F.col("rows").alias("auto"), F.lit(0).cast("bigint").alias("human")).unionAll(
        counts.select(F.col("corrected_label").alias("name"), F.lit(0).cast("bigint").alias("auto"), F.col("rows").alias("human"))
    )
    chance = (
        sides.groupBy("name")
        .agg(F.sum("auto").alias("auto"), F.sum("human").alias("human"))
        .agg(F.sum(F.col("auto").cast("double") * F.col("human")).alias("chance"))
    )
    agreed = counts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("label") == F.col("corrected_label"), F.col("rows"))), F.lit(0)).alias("agreed"),
    )
    n = F.col("n").cast("double")
    by_chance = F.col("chance") / (n * n)
    value = F.when((F.col("n") >= 2) & (by_chance < 1.0), (F.col("agreed") / n - by_chance) / (1.0 - by_chance))
    rows = side_by_side([agreed, chance]).select(F.col("n"), value.alias("_kappa"))
    # The wording of the interpretation.
    meaning = (
        F.when(F.col("_kappa").isNull(), "not calculated (need HITL corrections)")
        .when(F.col("_kappa") > 0.8, "excellent (>0.8)")
        .when(F.col("_kappa") > 0.6, "good (0.6-0.8)")
        .when(F.col("_kappa") > 0.4, "moderate (0.4-0.6)")
        .otherwise("fair (<0.4)")
    )
    return rows.select(
        F.round("_kappa", 3).alias("cohens_kappa"),
        F.when(F.col("n") >= 2, F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("kappa_n_samples"),
        meaning.alias("kappa_interpretation"),
    )


def review_impact(df: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Rows that each threshold would send to review, and their share: one pass for all."""
    confidence = to_double(F.col("confidence"))
    counts = df.agg(
        F.count("*").alias("_total"),
        *[count_where(confidence < value).alias(f"_below{i}") for i, value in enumerate(thresholds)],
    )
    rows = [
        F.struct(
            F.lit(float(value)).alias("threshold"),
            F.col(f"_below{i}").alias("rows_below"),
            pct(F.col(f"_below{i}"), F.col("_total")).alias("pct_below"),
        )
        for i, value in enumerate(thresholds)
    ]
    return counts.select(F.inline(F.array(*rows)))


def confidence_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """Rows per confidence bin over 0..1; the last bin includes 1."""
    place = F.floor(to_double(F.col("confidence")) * bins)
    return df.groupBy(F.least(place, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(F.count("*").alias("rows"))


def review_progress(queue: DataFrame) -> DataFrame:
    total, done = F.count("*"), count_where(is_corrected(strip_first=True))
    return queue.agg(
        total.alias("total"),
        done.alias("reviewed"),
        (total - done).alias("remaining"),
        pct(done, total).alias("progress_pct"),
    )


def browse_queue(
    queue: DataFrame, label: str | None = None, source: str | None = None, unreviewed_only: bool = True
) -> DataFrame:
    """Queue rows for one class and source, by default only those without a correction."""
    if label is not None:
        queue = queue.where(F.col("label").cast("string") == label)
    if source is not None:
        queue = queue.where(F.col("source").cast("string") == source)
    return queue.where(~is_corrected(strip_first=True)) if unreviewed_only else queue


def corrected_rows(queue: DataFrame, strip_first: bool = False) -> DataFrame:
    """Corrected queue rows as training rows of full confidence."""
    return queue.where(is_corrected(strip_first)).select(
        "id",
        "text",
        F.col("corrected_label").alias("label"),
        "source",
        F.lit(1.0).alias("confidence"),
        F.lit("hitl").alias("label_source"),
    )


def apply_corrections(queue: DataFrame, corrections: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """The queue with decisions (``id``, ``label``) written to ``corrected_label``.

    A decision without a label accepts the suggested one. Of several for one id the last by ``order_by``
    counts, then the greatest label. Rows without a decision stay as they are; ids not queued are left out.
    """
    label = F.coalesce(strip(F.col("label")), F.lit("")).alias("_label")
    decided = corrections.groupBy(F.col("id").cast("string").alias("_id")).agg(F.max(F.struct(*order_by, label)).alias("_last"))
    chosen = F.when(F.col("_last._label") != "", F.col("_last._label")).otherwise(F.col("suggested_label"))
    written = F.when(F.col("_last").isNotNull(), chosen).otherwise(F.col("corrected_label"))
    joined = queue.join(decided, F.col("id").cast("string") == F.col("_id"), "left")
    return joined.withColumn("corrected_label", written).drop("_id", "_last")


def merge_reviews(confident: DataFrame, queue: DataFrame) -> DataFrame:
    """Confident rows plus corrected ones."""
    return confident.unionByName(corrected_rows(queue), allowMissingColumns=True)


def retraining_rows(annotated: DataFrame, queue: DataFrame, mode: str = "append") -> DataFrame:
    """All annotated rows plus corrected ones.

    ``append`` keeps the original of a corrected row beside its correction; ``override``
    replaces it.
    """
    corrected = corrected_rows(queue, strip_first=True)
    if mode == "override":
        ids = small_side(corrected.select(F.col("id").cast("string").alias("_id")).distinct())
        annotated = annotated.join(ids, F.col("id").cast("string") == F.col("_id"), "left_anti")
    elif mode != "append":
        raise ValueError(f"mode must be 'append' or 'override', got {mode!r}")
    return annotated.unionByName(corrected, allowMissingColumns=True)


def progress_report(
    raw: DataFrame, cleaned: DataFrame, annotated: DataFrame, queue: DataFrame
) -> DataFrame:
    """One row over all stages: row counts, rows removed, mean confidence, reviewed rows."""
    count = F.count("*")
    report = side_by_side(
        [
            raw.agg(count.alias("total_rows")),
            cleaned.agg(count.alias("clean_rows")),
            annotated.agg(count.alias("annotated_rows"), F.round(F.avg("confidence"), 3).alias("_mean")),
            queue.agg(count.alias("review_queue_rows"), count_where(is_corrected(strip_first=True)).alias("reviewed_rows")),
        ]
    )
    removed = F.greatest(F.col("total_rows") - F.col("clean_rows"), F.lit(0))
    return report.select(
        "total_rows", "clean_rows", "annotated_rows", "review_queue_rows", "reviewed_rows",
        removed.cast("bigint").alias("rows_removed"),
        F.coalesce(F.col("_mean"), F.lit(0.0)).alias("confidence_mean"),
    )
