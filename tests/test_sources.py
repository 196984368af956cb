"""Ingest of landed files, collection and sinks."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from textloom.operators import prepare
from textloom.sources import ingest, sinks

LONG = [
    "Sourdough needs a warm kitchen, patience and a well fed starter.",
    "The museum opened a second hall for clocks of four centuries.",
    "Volunteers set three hundred young oaks beside the old canal.",
]


def test_merge_keeps_one_copy_and_the_schema(spark):
    text = "Rain kept the market closed until late afternoon"
    first = spark.createDataFrame([(text, "a"), ("Too short", "a")], "text string, source string")
    second = spark.createDataFrame([(text.upper(), "b", "x"), (f"  {text.lower()} ", "c", "y")], "text string, source string, label string")
    merged = ingest.merge([first, second])
    assert merged.columns == list(prepare.RAW_COLUMNS)
    rows = merged.collect()
    assert [(row.text, row.source) for row in rows] == [(text, "a")]
    assert rows[0].id == ingest.merge([second, first.limit(1)]).sparkSession.range(1).select(F.md5(F.lit(f"a\x01{text}"))).first()[0]


def test_inner_white_space_matters_when_collecting(spark):
    rows = spark.createDataFrame([("one two three four five six", "a"), ("one  two three four five six", "a")], "text string, source string")
    assert ingest.merge([rows]).count() == 2


def test_text_column(spark):
    rows = spark.createDataFrame([(i, str(i), text) for i, text in enumerate(LONG)], "i int, text string, description string")
    assert ingest.detect_text_column(rows, ["i"]) == "description"
    collected = ingest.ingest_table(rows, "shelf/plain-notes", ["i"], limit=2).collect()
    assert [row.source for row in collected] == ["huggingface_shelf_plain-notes"] * 2
    assert {row.label for row in collected} == {"unlabeled"} and collected[0].collected_at.endswith("+00:00")
    codes = spark.createDataFrame([(i, code) for i, code in enumerate(["K1", "L22", "P7", "T9"])], "i int, text string")
    assert ingest.detect_text_column(codes, ["i"]) is None
    assert ingest.ingest_table(codes, "x", ["i"]) is None


def test_nulls_count_in_the_unique_ratio(spark):
    values = [(i, LONG[0] if i < 1 else None) for i in range(4)]
    profile = ingest.text_column_profile(spark.createDataFrame(values, "i int, text string"), ["i"]).first()
    assert profile.unique_ratio == 0.25 and not profile.is_text


def test_csv(spark, tmp_path):
    path = tmp_path / "landed.csv"
    path.write_text("code,note\n" + "\n".join(f'{i},"{text}, said ""she"""' for i, text in enumerate(LONG)))
    rows = ingest.ingest_csv(ingest.read_csv(spark, str(path)), "owner/boats", ["code"], limit=2).collect()
    assert len(rows) == 2 and rows[0].source == "kaggle_boats" and rows[0].text.endswith('said "she"') and rows[0].id
    assert ingest.ingest_csv(ingest.read_csv(spark, str(path)), "owner/boats", ["code"], preferred="code") is None


def test_feed(spark, tmp_path):
    path = tmp_path / "feed.xml"
    path.write_text(
        "<rss><channel><title>T</title><item><title>Storm sails tested</title><description>What to hoist &amp; when</description></item>"
        "<item><title>A title long enough to stay</title></item><item><title>Tiny</title></item></channel></rss>"
    )
    rows = ingest.ingest_feed(spark, str(path), "https://www.example.com/feed").orderBy("text").collect()
    assert [row.text for row in rows] == ["A title long enough to stay", "Storm sails tested. What to hoist & when"]
    assert {row.source for row in rows} == {"rss_www.example.com"}


def test_questions(spark, tmp_path):
    path = tmp_path / "page.json"
    items = [{"title": "How do I reef in a gale?", "tags": ["sailing", "safety"]}, {"title": "Short", "tags": []}, {"title": "A long title without tags"}]
    path.write_text(json.dumps({"items": items, "has_more": False, "quota_remaining": 9}, indent=1))
    rows = ingest.ingest_questions(spark, str(path), "Sailing").orderBy("text").collect()
    assert [row.text for row in rows] == ["A long title without tags", "How do I reef in a gale? sailing safety"]
    assert {row.source for row in rows} == {"stackexchange_sailing"}


def titles(spark, page, rule, **settings):
    rows = spark.createDataFrame([(1, page)], "page_id int, html string")
    return [row.text for row in ingest.thread_titles(rows, rule, "forum", **settings).collect()]


def test_classic_forum(spark):
    name = "A thread title number {} that is long"
    links = [f'<a class="x title y" href="/t{i}"><b>{name.format(i)}</b></a>' for i in range(10)]
    links += [f"<a id='thread_title_{i}' href=/t>{name.format(i)}</a>" for i in range(10, 20)]
    assert titles(spark, "<a href='/showthread?9'>Not a title link at all</a>" + "\n".join(links), ingest.CLASSIC_FORUM) == [
        name.format(i) for i in range(15)
    ]
    fallback = "<a href='/showthread.php?t=1'>Tom &amp; Jerry sail around the Horn</a><a href='/x'>Some other long link text here</a>"
    assert titles(spark, fallback, ingest.CLASSIC_FORUM) == ["Tom & Jerry sail around the Horn"]


def test_cut_comes_before_the_length_test(spark):
    page = "".join(f'<a class="title">short {i}</a>' for i in range(15)) + '<a class="title">A title that is long enough</a>'
    assert titles(spark, page, ingest.CLASSIC_FORUM) == []


def test_modern_forum(spark):
    page = (
        '<a class="PreviewTooltip" href="/a">Preview tooltip thread title</a><a href="/plain">A plain link that does not count</a>'
        '<h3 class="big title"><a href="/b">Heading thread title, quite long</a></h3>'
        '<div class="structItem-title"><a href="/c">Struct item thread title, long</a></div>'
        '<a href="/threads/d">By address, a thread title here</a>'
    )
    assert titles(spark, page, ingest.MODERN_FORUM) == [
        "Preview tooltip thread title", "Heading thread title, quite long", "Struct item thread title, long", "By address, a thread title here",
    ]


def test_nested_containers(spark):
    """A container ends at its own end tag, not at the first one of its name."""
    page = (
        '<div class="structItem-title"><div>New</div><a href="/t/1">Inside, after an inner container</a></div>'
        '<a href="/u">Outside of any container, so not counted</a>'
        '<h3 class=title><span><p>x<a href="/t/2">Below a heading and <b>two</b> elements</a></h3><a href="/v">After the heading it is over</a>'
        '</span><div><div class="structItem-title"><br><img src="x"/><a/>'
        '<a href="/t/3">Tom <!-- no -->&amp; <i> Jerry</i><script>var a = "</b>";</script> sail on together</a>'
    )
    assert titles(spark, page, ingest.MODERN_FORUM) == [
        "Inside, after an inner container", "Below a heading andtwoelements", "Tom&Jerrysail on together",
    ]


def test_unclosed_and_nested_links(spark):
    page = '<a class="title" href=/1>An unclosed link goes on <a class="title" href=/2>and holds the next one</a></a> rest'
    assert titles(spark, page, ingest.CLASSIC_FORUM) == ["An unclosed link goes onand holds the next one", "and holds the next one"]
    assert titles(spark, "</a></div><p>" + "<i>" * 5000 + '<a class="title">Deep below many open elements', ingest.CLASSIC_FORUM) == ["Deep below many open elements"]
    assert titles(spark, None, ingest.CLASSIC_FORUM) == titles(spark, "", ingest.CLASSIC_FORUM) == []


def test_selection(spark):
    rows = spark.createDataFrame([("Yachting World",), ("forum x",)], "source string")
    assert ingest.selected_sources(rows, []).count() == 2
    assert [row.source for row in ingest.selected_sources(rows, ["Media / docs / yachting-world"]).collect()] == ["Yachting World"]


def test_unreadable_source_is_left_out(spark, tmp_path):
    path = str(tmp_path / "gone")
    spark.range(3).write.parquet(path)
    frame = spark.read.parquet(path)
    for file in (tmp_path / "gone").glob("*.parquet"):
        file.write_bytes(b"no parquet")
    assert list(ingest.available({"good": spark.range(1), "bad": frame})) == ["good"]


def test_first_existing(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "raw"))
    spark.range(2).write.parquet(str(tmp_path / "clean"))
    paths = [str(tmp_path / name) for name in ("annotated", "clean", "raw")]
    assert ingest.read_first_existing(spark, paths).count() == 2
    with pytest.raises(FileNotFoundError):
        ingest.read_first_existing(spark, paths[:1])


def test_review_queue_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", 'commas, "quotes"\nand a break \\', "safety", 0.5, "rss"), ("2", " spaces ", "x", 0.25, "f")],
        "id string, text string, label string, confidence double, source string",
    )
    sinks.write_review_queue(sinks.review_queue(rows), str(tmp_path / "queue"))
    got = ingest.read_review_queue(spark, str(tmp_path / "queue")).orderBy("id").collect()
    assert [(row.id, row.text, row.confidence, row.suggested_label) for row in got] == [
        ("1", 'commas, "quotes"\nand a break \\', 0.5, "safety"), ("2", " spaces ", 0.25, "x"),
    ]
    assert all(not row.corrected_label for row in got)


def test_label_studio(spark, tmp_path):
    rows = spark.createDataFrame([("7", "text here", "safety")], "id string, text string, label string")
    sinks.write_label_studio(rows, str(tmp_path / "tasks"))
    (line,) = [line for file in (tmp_path / "tasks").glob("*.json") for line in file.read_text().splitlines()]
    assert json.loads(line) == {
        "id": "7",
        "data": {"text": "text here"},
        "annotations": [{"result": [{"type": "choices", "value": {"choices": ["safety"]}, "from_name": "label", "to_name": "text"}]}],
    }
