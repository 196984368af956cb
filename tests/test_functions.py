"""Text and source-name expressions against plain Python."""

from __future__ import annotations

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from textloom.functions import patterns as P
from textloom.functions import source_names as N
from textloom.functions import text as T
from textloom.functions.numbers import pct, to_double
from textloom.functions.stopwords import ENGLISH, MARKUP, TEMPLATE, report_stopwords

TEXTS = [
    "  Anchoring\t in a crowded \n\n bay ",
    "\x1c Ärger über　Öl ",
    "",
    "   ",
    "ΟΔΥΣΣΕΥΣ İstanbul ﬁn ² Ⅷ नमस्ते",
    "Fish &amp; chips &lt;b&gt; &copy; 2024 &#39;x&#39; &#x41; &ampfoo AT&T &nope;",
    '<div class="a b" style = \'x\'>wp-content myWPfile -wp- keyassets_1</div>',
    "wp\nWP-wp-- ... attachment-medium, re-attachment! preWPpost éwpé",
    "<p>para</p> <pre> <p1> &AMP; CLASS = 'x'",
    "a-b_c9 x1 zz9- 9abc _abc hello-world_2 no",
]


def column(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [row[0] for row in rows.select("i", expression.alias("v")).orderBy("i").select("v").collect()]


# Those of the texts that change, by hand.
WITHOUT_MARKUP = {
    6: "     - -   ",
    7: " \n -- ...  ,  !    ",
    8: " para      &AMP;  ",
}


def without_artifacts(text):
    """Of a run of word characters and hyphens that holds an artifact word, only the outer hyphens stay."""
    kept = []
    for run, rest in re.findall(r"([\w-]*)([^\w-]*)", text):
        core = run.strip("-")
        hit = any(word in core.lower() for word in P.ARTIFACT_WORDS)
        kept.append((run.replace(core, " ") if hit else run) + rest)
    return "".join(kept)


@pytest.mark.parametrize(
    "expression, plain",
    [
        (T.collapse_whitespace, lambda t: re.sub(r"\s+", " ", t).strip()),
        (T.strip, str.strip),
        (T.dedup_key, lambda t: re.sub(r"\s+", " ", t).strip().lower()),
        (T.collection_key, lambda t: t.strip().lower()),
        (T.is_blank, lambda t: not t.strip()),
        (T.decode_entities, html.unescape),
        (T.remove_markup, lambda t: WITHOUT_MARKUP.get(TEXTS.index(t), t)),
        (T.has_artifact, lambda t: TEXTS.index(t) in (6, 7)),
        (T.has_markup, lambda t: bool(re.search(r"&(?:amp|#39|lt|gt|quot);|class\s*=|style\s*=|<div|<p\b", t, re.I))),
        (T.has_source_markup, lambda t: bool(re.search(P.ENTITY + "|href|nofollow|www", t, re.I))),
        (T.entity_count, lambda t: len(re.findall(P.ENTITY, t))),
        (T.corpus_tokens, lambda t: re.findall(r"[a-zA-Z][a-zA-Z0-9_-]{2,}", t.lower())),
        (T.model_tokens, lambda t: re.findall(r"\b\w\w+\b", t.lower())),
        (T.safe_class_name, lambda t: re.sub(r"\s+", "_", t.strip().lower())),
    ],
)
def test_text_functions(spark, expression, plain):
    assert column(spark, TEXTS, expression(F.col("t"))) == [plain(text) for text in TEXTS]


def test_markup_on_random_texts(spark):
    random.seed(3)
    pieces = ["wp", "-", "_", "a", "é", " ", "keyassets", "WP", ".", "x", "\n", "9", "wP-"]
    texts = ["".join(random.choices(pieces, k=random.randint(0, 25))) for _ in range(400)]
    assert column(spark, texts, T.remove_markup(F.col("t"))) == [without_artifacts(text) for text in texts]


def test_artifact_search_is_linear(spark):
    texts = ["abc-" * 250_000, "abc-" * 250_000 + "wp-" + " wp abc-", "-" * 500_000 + " wp"]
    column(spark, ["abc- wp"], T.remove_markup(F.col("t")))
    began = time.monotonic()
    assert [len(text) for text in column(spark, texts, T.remove_markup(F.col("t")))] == [1_000_000, 9, 500_002]
    assert time.monotonic() - began < 10


def test_null_text_stays_null(spark):
    assert column(spark, [None, "a &amp; b"], T.decode_entities(F.col("t"))) == [None, "a & b"]


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (2, 3), (3, 3)])
def test_ngrams(spark, low, high):
    texts = ["", "aa", "aa bb", "aa bb cc", "aa bb cc dd aa bb"]
    got = column(spark, texts, T.ngrams(T.model_tokens(F.col("t")), low, high))
    for text, grams in zip(texts, got):
        words = text.split()
        assert grams == [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def test_source_names(spark):
    def one(expression, value):
        return column(spark, [value], expression(F.col("t")))[0]

    assert one(N.normalize_source, " 48° North & Co. ") == "48 north and co"
    assert one(N.selection_name, "Media / docs / Yachting World") == "yachting world"
    assert one(N.feed_display_name, "https://www.yachtingworld.com/feed") == "Yachting World"
    assert one(N.feed_display_name, "https://blog.example.org/x") == "blog.example.org"
    assert one(N.feed_short_label, "HTTPS://feeds.48north.com/feed/") == "48° North"
    assert one(N.feed_short_label, "https://www.example.org/feed/") == "example.org"
    assert one(N.tag_slug, "Sail & Boats!") == "sail_boats"
    assert one(N.tag_slug, "!!!") == "tagged"
    assert one(N.display_name, "huggingface_a_b") == "HuggingFace / a b"
    assert one(N.display_name, "rss_www.a_b.com") == "RSS / www.a_b.com"
    assert one(N.display_name, "Big_Forum") == "Forum / Big_Forum"
    assert one(N.display_name, None) == ""
    assert one(N.license_type, "STACKEXCHANGE_x") == "CC BY-SA 4.0"
    assert one(N.license_status, "other") == "—"
    assert [one(N.is_thematic, s) for s in ("rss_x", "huggingface_forum", "my_forum", "unknown", "", None, " SailingForums ", "misc")] == [
        True, False, True, False, False, False, True, False,
    ]
    assert [one(N.topical_fit, s) for s in ("huggingface_x", "rss_x", "sailingforums", "boat_forum")] == ["low", "high", "high", "medium"]


def test_numbers(spark):
    rows = spark.createDataFrame([("0.5",), ("abc",), (None,), ("NaN",)], "v string")
    assert [row[0] for row in rows.select(to_double(F.col("v"))).collect()] == [0.5, 0.0, 0.0, 0.0]
    assert spark.range(1).select(pct(F.lit(1), F.lit(3)), pct(F.lit(1), F.lit(0))).first()[:] == (33.33, 0.0)


def test_stopwords():
    words = report_stopwords("Minecraft and mods", ["minecraft_and_mods_basics", "weather_basics"])
    assert ENGLISH | MARKUP | TEMPLATE | {"minecraft", "mods"} == words
    assert "basics" in report_stopwords("Minecraft", ["minecraft_basics"])


def test_quick_searches_change_no_result(spark):
    texts = [None, "", "plain words", "a wp b", "WP", "\u212aeyassets", "figcapt\u0131on x", "t\u0131meincuk", "a&amp;b", "class = x", "<div>", "x<p", "a  b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    c = F.col("text")
    rows = df.select(
        T.has_markup(c), c.rlike(P.MARKUP_ISSUE), T.has_artifact(c), c.rlike(P.holds_artifact_word(P.ARTIFACT_WORDS)) & c.rlike(P.artifact_word(P.ARTIFACT_WORDS)),
    ).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in rows) and any(r[0] for r in rows) and sum(bool(r[2]) for r in rows) >= 4
    # A search for bytes comes before either pattern.
    assert all("Contains(" in df.select(f(c))._jdf.queryExecution().analyzed().toString() for f in (T.has_markup, T.has_artifact))
