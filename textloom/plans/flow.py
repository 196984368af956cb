"""The steps of a curation run, joined by tables: collect, clean, label, review, learn, train.

Every step reads the table of the step before and writes its own, so a run can be taken up again
at any step and no step recomputes an earlier one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from textloom.functions.source_names import is_thematic
from textloom.functions.stopwords import report_stopwords
from textloom.operators import active, classifier, corpus, labelling, quality
from textloom.sources import ingest, sinks, versions


@dataclass(frozen=True)
class Workspace:
    """Where the tables of one run live: a folder that all executors share."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return versions.read(spark, self.path(name))

    def write(self, df: DataFrame, name: str) -> None:
        """Replace a table; readers of the version before go on."""
        versions.write(df, self.path(name))

    def best(self, spark: SparkSession) -> DataFrame:
        """The richest table there is: annotated before clean before raw."""
        return versions.read_first_existing(spark, [self.path(name) for name in ("annotated", "clean", "raw")])


def collect(spark: SparkSession, sources: Mapping[str, DataFrame], at: Workspace, order_by: Sequence[str] = ()) -> DataFrame:
    """Merge the readable sources, in the order given, into the raw table; returns its metrics."""
    merged = ingest.merge(list(ingest.available(dict(sources)).values()), order_by)
    at.write(merged, "raw")
    return ingest.collection_metrics(at.read(spark, "raw"))


def clean(spark: SparkSession, at: Workspace, strategy: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean the raw table; returns the quality report and the before/after comparison."""
    raw = at.read(spark, "raw")
    at.write(quality.clean(raw, ["id"], strategy), "clean")
    cleaned = at.read(spark, "clean")
    comparison = quality.compare(raw, cleaned, ["id"])
    sinks.write_metrics(quality.metric_rows(comparison), at.path("quality_metrics"))
    return quality.detect_issues(raw, ["id"]), comparison


def annotate(
    spark: SparkSession,
    at: Workspace,
    keywords: Mapping[str, Sequence[str]] = labelling.DEFAULT_KEYWORDS,
    scorer=None,
    threshold: float = labelling.CONFIDENCE_THRESHOLD,
    reviews: DataFrame | None = None,
) -> DataFrame:
    """Label the clean table, write the annotated table, the review queue and the task export.

    Returns the annotation report; earlier ``reviews`` add the agreement to it.
    """
    rows = at.read(spark, "clean")
    labelled = (
        labelling.auto_label(rows, keywords)
        if scorer is None
        else labelling.auto_label_with(rows, scorer, tuple(keywords))
    )
    at.write(labelled, "annotated")
    annotated = at.read(spark, "annotated")
    review = labelling.split_by_confidence(annotated, threshold)[1]
    sinks.write_review_queue(sinks.review_queue(review), at.path("review_queue"))
    sinks.write_label_studio(annotated, at.path("label_studio"))
    return labelling.annotation_quality(annotated, threshold, queue=reviews)


def reviewed(
    spark: SparkSession, at: Workspace, reviews: DataFrame | None = None, threshold: float = labelling.CONFIDENCE_THRESHOLD
) -> DataFrame:
    """Confident rows, with the corrections of ``reviews`` merged in where given."""
    confident = labelling.split_by_confidence(at.read(spark, "annotated"), threshold)[0]
    return confident if reviews is None else labelling.merge_reviews(confident, reviews)


@dataclass(frozen=True)
class Run:
    collection: DataFrame
    quality: DataFrame
    comparison: DataFrame
    annotation: DataFrame
    learning: DataFrame | None
    training: classifier.TrainingResult
    progress: DataFrame


def run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    at: Workspace,
    keywords: Mapping[str, Sequence[str]] = labelling.DEFAULT_KEYWORDS,
    reviews: DataFrame | None = None,
    skip_review: bool = False,
    skip_learning: bool = False,
    iterations: int = active.ITERATIONS,
    order_by: Sequence[str] = (),
) -> Run:
    """A whole run. Reviews are an input, because the queue is written anew on the way."""
    collection = collect(spark, sources, at, order_by)
    report, comparison = clean(spark, at)
    annotation = annotate(spark, at, keywords, reviews=reviews)
    queue = ingest.read_review_queue(spark, at.path("review_queue")) if reviews is None else reviews
    rows = reviewed(spark, at, None if skip_review else reviews)
    learning = None if skip_learning else active.run_cycle(rows, queue, iterations=iterations)
    training = classifier.train_or_skip(rows)
    if training.model is not None:
        training.model.save(spark, at.path("model"))
    sinks.write_metrics(training.metrics, at.path("model_metrics"))
    tables = [at.read(spark, name) for name in ("raw", "clean", "annotated")]
    return Run(collection, report, comparison, annotation, learning, training, labelling.progress_report(*tables, queue))


def corpus_report(df: DataFrame, topic: str = "", classes: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All tables of the corpus report."""
    stopwords = report_stopwords(topic, classes)
    by_source = corpus.source_quality(df)
    return {
        "sources": corpus.source_table(df),
        "thematic_split": corpus.thematic_split(df),
        "source_quality": by_source,
        "issues": corpus.issue_ranking(by_source),
        "insights": corpus.insights(by_source),
        "hypotheses": corpus.source_hypotheses(df),
        "length_statistics": corpus.length_statistics(df),
        "length_histogram": corpus.length_histogram(df),
        "length_boxes": corpus.length_boxes(df),
        "token_counts": corpus.token_counts(df, stopwords),
        "thematic_token_counts": corpus.token_counts(df.where(is_thematic(df["source"])), stopwords),
        "top_tokens_by_source": corpus.top_tokens_by_source(df, stopwords),
        "summary": corpus.dataset_summary(df),
    }
