"""Automatic labels, review and agreement."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa
import pytest

from textloom.operators import labelling
from textloom.sources import sinks

TEXTS = [
    ("1", "Tide and course: set a waypoint before the tide turns", "forum"),
    ("2", "The wind and storm forecast; sea   state rising", "rss"),
    ("3", "Anchor storm", None),
    ("4", "Cooking pasta at home", "blog"),
]


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(TEXTS, "id string, text string, source string")


def test_keyword_labels(rows):
    got = {row.id: row for row in labelling.auto_label(rows).collect()}
    assert (got["1"].label, got["1"].confidence, got["1"].label_source) == ("navigation", 1.0, "keyword")
    assert (got["2"].label, got["2"].confidence) == ("weather", 1.0)
    assert (got["3"].label, got["3"].confidence, got["3"].source) == ("equipment", 0.5, "unknown")
    assert (got["4"].label, got["4"].confidence, got["4"].label_source) == ("other_or_offtopic", 0.0, "fallback")


def test_without_scorer_everything_goes_to_review(rows):
    got = labelling.auto_label_with(rows, None).collect()
    assert {(row.label, row.confidence, row.label_source) for row in got} == {("other_or_offtopic", 0.0, "fallback")}


def test_failing_batch_falls_back_alone(spark):
    rows = spark.createDataFrame([(str(i), "bad" if i == 20 else "fine") for i in range(48)], "id string, text string").coalesce(1)

    def scorer(texts, labels):
        if "bad" in texts:
            raise RuntimeError("model failed")
        return [(labels[0], 2 / 3)] * len(texts)

    got = labelling.auto_label_with(rows, scorer).collect()
    assert sum(row.label_source == "fallback" for row in got) == 16
    assert {(row.label, row.confidence) for row in got if row.label_source == "zero_shot"} == {("navigation", 0.666667)}


def test_lazy_scorer_and_blank_label(rows):
    got = labelling.auto_label_with(rows, lambda: lambda texts, labels: [(" ", 0.4)] * len(texts), lazy=True).collect()
    assert {(row.label, row.confidence, row.label_source) for row in got} == {("other_or_offtopic", 0.4, "zero_shot")}


def test_split(spark):
    rows = spark.createDataFrame([(str(i), "t", c) for i, c in enumerate(["0.9", "0.5", "0.8", "x"])], "id string, text string, confidence string")
    confident, review = labelling.split_by_confidence(rows)
    assert sorted(row.confidence for row in confident.collect()) == [0.8, 0.9]
    assert sorted(row.confidence for row in review.collect()) == [0.0, 0.5]


def test_quality_report(spark):
    rows = spark.createDataFrame(
        [("1", "a", "navigation", 0.9, "m"), ("2", "b", "safety", 0.5, "m"), ("3", "c", "other_or_offtopic", 0.1, None)],
        "id string, text string, label string, confidence double, label_source string",
    )
    report = labelling.annotation_quality(rows).first()
    assert (report.total_labeled, report.review_label_count, report.low_confidence_count, report.low_confidence_pct) == (3, 1, 2, 66.67)
    assert (report.confidence_mean, report.confidence_std) == (0.5, 0.3266)
    assert report.label_source_distribution == {"m": 2, "fallback": 1}


QUEUE = "id string, text string, label string, confidence double, source string, suggested_label string, corrected_label string"


def queue(spark, corrections):
    return spark.createDataFrame(
        [(str(i + 1), f"t{i}", label, 0.5, "s", label, fixed) for i, (label, fixed) in enumerate(corrections)], QUEUE
    )


def test_kappa(spark):
    annotated = spark.createDataFrame([("1",), ("2",), ("9",)], "id string")
    got = labelling.kappa(annotated, queue(spark, [("navigation", "navigation"), ("safety", "equipment"), ("x", "")])).first()
    assert (got.cohens_kappa, got.kappa_n_samples, got.kappa_interpretation) == (0.333, 2, "fair (<0.4)")


@pytest.mark.parametrize("corrections, n", [([("a", "a")], 0), ([("a", "a"), ("a", "a")], 2), ([], 0)])
def test_kappa_is_null_when_undefined(spark, corrections, n):
    annotated = spark.createDataFrame([("1",), ("2",)], "id string")
    got = labelling.kappa(annotated, queue(spark, corrections)).first()
    assert (got.cohens_kappa, got.kappa_n_samples) == (None, n)
    assert got.kappa_interpretation.startswith("not calculated")


def test_kappa_counts_repeated_ids_like_a_join(spark):
    annotated = spark.createDataFrame([("1",), ("1",), ("1",), ("2",)], "id string")
    reviews = queue(spark, [("a", "a"), ("a", "b")])
    reviews = reviews.unionByName(reviews)
    counts = {(row.label, row.corrected_label): row.rows for row in labelling.agreement_counts(annotated, reviews).collect()}
    assert counts == {("a", "a"): 6, ("a", "b"): 2}


def test_merge_and_retraining(spark):
    confident = spark.createDataFrame(
        [("8", "x", "navigation", "s", 0.9, "m"), ("9", "y", "safety", "s", 0.8, "m")],
        "id string, text string, label string, source string, confidence double, label_source string",
    )
    reviews = queue(spark, [("navigation", "safety"), ("safety", None), ("safety", "  ")])
    merged = labelling.merge_reviews(confident, reviews.where("id <> '3'")).collect()
    assert len(merged) == 3 and [(row.id, row.label, row.confidence) for row in merged if row.label_source == "hitl"] == [("1", "safety", 1.0)]
    annotated = confident.unionByName(reviews.select("id", "text", "label", "source", "confidence").selectExpr("*", "'m' label_source"))
    assert labelling.retraining_rows(annotated, reviews).count() == 6
    override = labelling.retraining_rows(annotated, reviews, "override")
    assert {row.id: row.label for row in override.collect()}["1"] == "safety" and override.count() == 5


def test_progress(spark):
    reviews = queue(spark, [("a", "b"), ("a", " "), ("a", None), ("a", "")])
    assert labelling.review_progress(reviews).first()[:] == (4, 1, 3, 25.0)
    assert labelling.browse_queue(reviews, label="a", source="s").count() == 3
    assert labelling.browse_queue(reviews, label="z").count() == 0
    assert sinks.review_queue(reviews).columns == QUEUE.replace(",", "").split()[::2]


def test_review_impact_and_histogram(spark):
    rows = spark.createDataFrame([("0.0",), ("0.5",), ("1.0",), ("bad",)], "confidence string")
    assert [row[:] for row in labelling.review_impact(rows, [0.5, 2.0]).collect()] == [(0.5, 2, 50.0), (2.0, 4, 100.0)]
    assert {row.bin: row.rows for row in labelling.confidence_histogram(rows).collect()} == {0: 2, 15: 1, 29: 1}


def test_apply_corrections(spark):
    queue = spark.createDataFrame(
        [("1", "safety", ""), ("2", "weather", ""), ("3", "weather", "old"), ("4", "weather", "old"), (None, "x", "")],
        "id string, suggested_label string, corrected_label string",
    )
    decisions = spark.createDataFrame(
        [("1", None, 1), ("2", "a", 2), ("2", " b ", 1), ("3", "c", 1), ("9", "d", 1), (None, "e", 1)], "id string, label string, turn int"
    )
    got = labelling.apply_corrections(queue, decisions, ["turn"])
    assert {row.id: row.corrected_label for row in got.collect()} == {"1": "safety", "2": "a", "3": "c", "4": "old", None: ""}
    assert labelling.apply_corrections(queue, decisions.limit(0), ["turn"]).where("corrected_label = 'old'").count() == 2
    assert labelling.apply_corrections(queue.limit(0), decisions).count() == 0


def test_deviation_of_close_confidences(spark):
    """Large and nearly equal values: a difference of squares would lose all digits."""
    rows = [(str(i), "text", label, 1e8 + (1e-3 if i % 2 else -1e-3), "zero-shot") for label in ("a", "b") for i in range(50)]
    df = spark.createDataFrame(rows, "id string, text string, label string, confidence double, label_source string")
    report = labelling.annotation_quality(df).first()
    assert report.confidence_mean == 1e8 and report.confidence_std == 0.001


def test_a_scorer_holds_one_batch_of_texts():
    batch = pa.RecordBatch.from_pydict({"id": list(range(5000)), "text": [f"{i} " + "x" * 4000 for i in range(5000)]})
    score = lambda texts, labels: [(labels[0], len(t) / 10_000) for t in texts]
    tracemalloc.start()
    try:
        out = list(labelling._with_scores(iter([batch]), score, ["a", "b"], "review", "own", 16))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # All texts as Python strings would be 20 MB.
    assert peak < 4e6 and out[0].num_rows == 5000
    assert out[0].slice(17, 1).to_pylist() == [{"id": 17, "text": "17 " + "x" * 4000, "label": "a", "confidence": 0.4003, "label_source": "own"}]
