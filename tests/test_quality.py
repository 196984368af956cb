"""Issue detectors and cleaning strategies, each alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textloom.operators import prepare, quality

SCHEMA = "i int, id string, text string, label string, source string, collected_at string"
STAMP = "2024-01-01T00:00:00+00:00"
MARKED = 'Fish &amp; chips <div class="wp-content"> attachment-medium guide to storm sails for offshore crews'
ROWS = [
    (1, "a", MARKED, "unlabeled", "rss", STAMP),
    (2, "b", "Short note", "unlabeled", "rss", STAMP),
    (3, "c", MARKED, "unlabeled", "rss", STAMP),
    (4, "d", "storm routing " * 150, "other", "forum", STAMP),
]
KEEP = dict.fromkeys(quality.DEFAULT_STRATEGY, "keep")


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_report(rows):
    report = quality.detect_issues(rows, ["i"]).first()
    assert (report.total_rows, report.duplicates, report.short_texts, report.long_texts) == (4, 1, 1, 1)
    assert (report.html_entities, report.html_artifacts, report.fuzzy_pairs) == (2, 2, 1)
    assert report.patterns == ["attachment", "wp"]
    assert report.html_examples == [MARKED[:150]] * 2
    assert report.label_distribution == {"unlabeled": 3, "other": 1}
    assert (report.imbalance_ratio, report.issues_found, report.missing_count) == (3.0, 7, 0)


def test_missing_never_counts_text(spark):
    rows = spark.createDataFrame([(1, None, None, 1.0), (2, "x", "s", float("nan"))], "i int, text string, source string, v double")
    got = quality.missing_cells(rows).first()
    assert got.missing_count == 2 and got.missing_columns == ["source", "v"]
    assert prepare.handle_missing(prepare.prepare_quality(rows), "drop").count() == 0
    filled = prepare.handle_missing(prepare.prepare_quality(rows), "fill").orderBy("i").collect()
    assert [row.source for row in filled] == ["", "s"]


def test_text_is_required(spark):
    with pytest.raises(ValueError, match="text"):
        quality.detect_issues(spark.range(1), ["id"])


@pytest.mark.parametrize(
    "step, value, expected",
    [
        ("duplicates", "drop", 3),
        ("short_texts", "filter", 3),
        ("long_texts", "filter", 3),
        ("long_texts", "truncate", 4),
        ("fuzzy_duplicates", "remove", 3),
        ("html_entities", "decode", 4),
        ("html_artifacts", "remove", 4),
    ],
)
def test_each_strategy_alone(rows, step, value, expected):
    cleaned = quality.clean(rows, ["i"], {**KEEP, step: value}).collect()
    assert len(cleaned) == expected
    texts = " ".join(row.text for row in cleaned)
    assert ("&amp;" in texts) == (step != "html_entities")
    assert ("attachment" in texts) == (step != "html_artifacts")
    assert max(len(row.text) for row in cleaned) <= (1000 if step == "long_texts" else 2100)


def test_full_cleaning_leaves_no_blank_text(rows):
    cleaned = quality.clean(rows.unionByName(rows.withColumns({"i": F.lit(9), "text": F.lit("  ")})), ["i"])
    texts = {row.i: row.text for row in cleaned.collect()}
    assert set(texts) == {1, 4}
    assert texts[1] == "Fish & chips guide to storm sails for offshore crews"
    assert len(texts[4]) == 999 and texts[4].endswith("storm")
    assert cleaned.columns == ["i", "id", "text", "label", "source", "collected_at"]


def test_near_duplicates(spark):
    texts = ["Reefing early keeps the boat upright in a gale.", "Reefing early keeps the boat upright in a gale!", "Unrelated"]
    rows = spark.createDataFrame([(i, text, "x") for i, text in enumerate(texts)], "i int, text string, label string")
    pairs = quality.find_fuzzy_duplicates(rows, ["i"]).collect()
    assert [(p.pos_1, p.pos_2) for p in pairs] == [(0, 1)] and pairs[0].similarity >= 90
    assert quality.clean(rows, ["i"], {**KEEP, "fuzzy_duplicates": "remove"}).count() == 2


def test_comparison_and_metric_rows(rows):
    comparison = quality.compare(rows, quality.clean(rows, ["i"]), ["i"])
    got = comparison.first()
    assert (got.rows_before, got.rows_after, got.rows_removed, got.pct_removed) == (4, 2, 2, 50.0)
    assert (got.duplicates_before, got.duplicates_after, got.html_entities_after) == (1, 0, 0)
    metrics = {row.metric: row for row in quality.metric_rows(comparison).collect()}
    assert metrics["Rows"].improvement == -2 and metrics["Short texts"].improvement == 1


@pytest.mark.parametrize("counts, ratio", [([], 0.0), ([("a", 7)], 7.0), ([("a", 7), ("b", 2), ("c", 0)], 3.5)])
def test_imbalance(spark, counts, ratio):
    assert quality.imbalance_ratio(spark.createDataFrame(counts, "label string, rows bigint")).first()[0] == ratio


def test_empty_frame(spark):
    empty = spark.createDataFrame([], SCHEMA)
    report = quality.detect_issues(empty, ["i"]).first()
    assert report.total_rows == 0 and report.short_pct == 0.0 and report.issues_found == 0
    assert quality.clean(empty, ["i"]).count() == 0
