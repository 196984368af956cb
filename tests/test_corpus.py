"""Corpus reports."""

from __future__ import annotations

import statistics

import pytest

from textloom.operators import corpus, prepare

ROWS = [
    ("rss_a", "Storm &amp; wind reports for the storm coast of Brittany and the Channel", ),
    ("rss_a", "Short"),
    ("huggingface_x", "feeling happy happy happy today"),
    ("huggingface_x", " Feeling happy happy happy TODAY "),
    (None, "x" * 1200),
]


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(ROWS, "source string, text string")


def test_source_quality(rows):
    got = {row.source: row for row in corpus.source_quality(rows).collect()}
    assert got["rss_a"].html_pct == 50.0 and got["rss_a"].short_pct == 50.0
    assert got["huggingface_x"].duplicates_pct == 50.0 and got["unknown"].long_pct == 100.0
    assert got["huggingface_x"].avg_len == statistics.mean(len(t) for s, t in ROWS if s == "huggingface_x")


def test_issue_ranking_and_insights(rows):
    quality = corpus.source_quality(rows)
    ranked = corpus.issue_ranking(quality, 2).collect()
    assert [(row.issue, row.source, row.value) for row in ranked] == [("short texts", "huggingface_x", 100.0), ("long texts", "unknown", 100.0)]
    got = corpus.insights(quality).first()
    assert (got.total_rows, got.sources, got.huggingface_pct, got.top_source, got.longest_source, got.max_len) == (5, 3, 40.0, "huggingface_x", "unknown", 1200)
    assert got.rss_html_pct == 50.0 and not got.mostly_bootstrap


def test_thematic_split(rows):
    assert corpus.thematic_split(rows).first()[:] == (2, 3, 40.0, 60.0)


def test_summary_holds_no_texts(rows):
    got = corpus.dataset_summary(rows).first()
    assert got.total_rows == 5 and got.html_entity_count == 1 and got.max_text_len == 1200
    assert got.source_distribution == {"rss_a": 2, "huggingface_x": 2, "unknown": 1}
    assert got.top_keywords_global[:3] == ["happy", "feeling", "storm"]
    assert got.top_keywords_by_source["rss_a"][0] == "storm"
    assert not any(text in str(got) for _, text in ROWS if text.count(" ") > 2)


def test_summary_of_nothing(spark):
    got = corpus.dataset_summary(spark.createDataFrame([], "source string, text string")).first()
    assert (got.total_rows, got.avg_text_len, got.pct_short_texts, got.top_keywords_global) == (0, 0.0, 0.0, [])


def test_lengths(spark):
    lengths = [3, 4, 5, 6, 7, 8, 9, 200]
    rows = spark.createDataFrame([("s", "x" * n) for n in lengths], "source string, text string")
    got = corpus.length_statistics(rows).first()
    assert got.median_len == 6.5 and got.p95_len == pytest.approx(133.15) and got.mean_len == 30.25
    assert [row[:] for row in corpus.length_histogram(rows, 10).collect()] == [(0, 7), (9, 1)]
    box = corpus.length_boxes(rows).first()
    assert (box.median, box.lower_fence, box.upper_fence, box.outliers) == (6.5, 3, 9, 1)
    assert [row.text_len for row in corpus.length_outliers(rows).collect()] == [200]


def test_tokens_keep_multiplicity(rows):
    got = {row.token: row.n for row in corpus.token_counts(rows, {"the", "and", "for"}).collect()}
    assert got["happy"] == 6 and got["storm"] == 2 and "the" not in got
    top = corpus.top_tokens_by_source(rows, {"the"}, 1)
    assert {row.source: row.token for row in top.collect()}["huggingface_x"] == "happy"


def test_source_table(rows):
    got = {row.source: row for row in corpus.source_table(rows).collect()}
    assert got["rss_a"].display_name == "RSS / a" and got["unknown"].license == "unknown" and got["huggingface_x"].fit == "low"


def test_pages(spark):
    listing = spark.range(25)
    assert [row.id for row in prepare.page(listing, 3, ["id"]).collect()] == [20, 21, 22, 23, 24]
    assert prepare.page(listing, 0, ["id"]).count() == 10
