"""Corpus reports: sources, lengths, vocabulary and the summary of a dataset."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import patterns as P
from textloom.functions import source_names as S
from textloom.functions.numbers import count_where, pct
from textloom.functions.stopwords import SUMMARY
from textloom.functions.text import (
    collection_key,
    corpus_tokens,
    entity_count,
    has_source_markup,
    is_blank,
)
from textloom.operators import prepare
from textloom.operators.dedup import duplicate_count
from textloom.operators.frames import as_map, side_by_side, top_per_group
from textloom.plans.session import small_side


def prepare_corpus(df: DataFrame) -> DataFrame:
    """Text and source non-null, plus the text length."""
    prepare.require(df, "text")
    return df.withColumns(
        {"text": prepare.string_or(df, "text", ""), "source": prepare.string_or(df, "source", "unknown")}
    ).withColumn("text_len", F.length("text").cast("bigint"))


def source_quality(df: DataFrame) -> DataFrame:
    """Quality metrics per source, largest source first.

    One pass. The distinct count groups by (source, text digest) before it groups by source, so
    a source that holds a third of the corpus is spread over all tasks.
    """
    rows = F.count("*")
    length = F.col("text_len")
    html = pct(count_where(has_source_markup(F.col("text"))), rows)
    short = pct(count_where(length < P.SHORT_TEXT_MIN), rows)
    return (
        prepare_corpus(df)
        .groupBy("source")
        .agg(
            rows.alias("rows"),
            F.round(F.sum(length) / rows, 2).alias("avg_len"),
            F.min(length).alias("min_len"),
            F.max(length).alias("max_len"),
            pct(count_where(is_blank(F.col("text"))), rows).alias("empty_pct"),
            short.alias("short_pct"),
            pct(count_where(length > P.LONG_TEXT_MAX), rows).alias("long_pct"),
            html.alias("html_pct"),
            pct(duplicate_count(collection_key(F.col("text")), blank_counts=True), rows).alias("duplicates_pct"),
        )
        .orderBy(F.desc("rows"), "source")
    )


def source_distribution(df: DataFrame) -> DataFrame:
    """Rows per source and its share of the total."""
    counts = df.groupBy(prepare.string_or(df, "source", "unknown").alias("source")).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    share = F.round(100.0 * F.col("rows") / total, 2)
    return counts.withColumn("share_pct", share).orderBy(F.desc("rows"), "source")


def source_table(df: DataFrame) -> DataFrame:
    """Source listing with readable name, licence, status and topical fit."""
    return source_distribution(df).select(
        "source",
        S.display_name(F.col("source")).alias("display_name"),
        "rows",
        S.license_type(F.col("source")).alias("license"),
        S.license_status(F.col("source")).alias("status"),
        S.topical_fit(F.col("source")).alias("fit"),
    )


def thematic_split(df: DataFrame) -> DataFrame:
    total, on_topic = F.count("*"), count_where(S.is_thematic(F.col("source")))
    return df.agg(
        on_topic.alias("thematic_rows"),
        (total - on_topic).alias("off_topic_rows"),
        pct(on_topic, total).alias("thematic_pct"),
        pct(total - on_topic, total).alias("off_topic_pct"),
    )


def length_counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows per text length: all length statistics derive from this small table."""
    return prepare_corpus(df).groupBy(*by, "text_len").agg(F.count("*").alias("rows"))


def length_statistics(df: DataFrame) -> DataFrame:
    """Mean, median, 95th percentile (exact, linear interpolation) and range of text length."""
    rows, length = F.col("rows"), F.col("text_len")
    return length_counts(df).agg(
        F.sum("rows").alias("rows"),
        F.round(F.sum(length * rows) / F.sum(rows), 4).alias("mean_len"),
        F.percentile("text_len", 0.5, rows).alias("median_len"),
        F.round(F.percentile("text_len", 0.95, rows), 4).alias("p95_len"),
        F.min("text_len").alias("min_len"),
        F.max("text_len").alias("max_len"),
    )


def length_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Rows per equal-width length bin between the shortest and the longest text."""
    counts = length_counts(df)
    low, high = counts.agg(F.min("text_len")).scalar(), counts.agg(F.max("text_len")).scalar()
    counts = counts.select("text_len", "rows", low.alias("low"), high.alias("high"))
    place = F.floor((F.col("text_len") - F.col("low")) * bins / (F.col("high") - F.col("low")))
    bin_number = F.when(F.col("high") > F.col("low"), F.least(place, F.lit(bins - 1))).otherwise(0)
    return counts.groupBy(bin_number.cast("bigint").alias("bin")).agg(F.sum("rows").alias("rows")).orderBy("bin")


def _quartiles(counts: DataFrame) -> DataFrame:
    """Quartiles and fence distances per source, from rows per source and length."""
    quartiles = counts.groupBy("source").agg(F.percentile("text_len", [0.25, 0.5, 0.75], F.col("rows")).alias("_q"))
    return quartiles.select(
        "source", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3")
    )


def _outside() -> Column:
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    return (F.col("text_len") < F.col("q1") - spread) | (F.col("text_len") > F.col("q3") + spread)


def length_boxes(df: DataFrame) -> DataFrame:
    """Box-plot numbers per source: quartiles, fences and rows beyond them."""
    counts = length_counts(df, "source")
    return (
        counts.join(_quartiles(counts), "source")
        .groupBy("source", "q1", "median", "q3")
        .agg(
            F.min(F.when(~_outside(), F.col("text_len"))).alias("lower_fence"),
            F.max(F.when(~_outside(), F.col("text_len"))).alias("upper_fence"),
            F.coalesce(F.sum(F.when(_outside(), F.col("rows"))), F.lit(0)).alias("outliers"),
        )
        .orderBy("source")
    )


def length_outliers(df: DataFrame) -> DataFrame:
    """Rows whose text length lies beyond the fences of their source."""
    quartiles = small_side(_quartiles(length_counts(df, "source")))
    return prepare_corpus(df).join(quartiles, "source").where(_outside()).drop("q1", "median", "q3")


def tokens(df: DataFrame, stopwords: Iterable[str] = (), *by: str) -> DataFrame:
    """One row per token occurrence, without stopwords."""
    rows = df.select(*by, F.explode(corpus_tokens(prepare.string_or(df, "text", ""))).alias("token"))
    words = sorted(stopwords)
    # A literal set: looked up by hash, nothing is joined or shuffled.
    return rows.where(~F.col("token").isin(words)) if words else rows


def token_counts(df: DataFrame, stopwords: Iterable[str] = (), *by: str) -> DataFrame:
    return tokens(df, stopwords, *by).groupBy(*by, "token").agg(F.count("*").alias("n"))


def top_tokens(df: DataFrame, stopwords: Iterable[str] = (), limit: int = 5) -> DataFrame:
    """Most frequent tokens; ties in alphabetical order."""
    return token_counts(df, stopwords).orderBy(F.desc("n"), "token").limit(limit)


def top_tokens_by_source(df: DataFrame, stopwords: Iterable[str] = (), limit: int = 10) -> DataFrame:
    counts = token_counts(df, stopwords, "source")
    return top_per_group(counts, "source", limit, F.desc("n"), F.col("token"))


def dataset_summary(df: DataFrame, global_terms: int = 15, source_terms: int = 8) -> DataFrame:
    """Summary of a dataset as one row; it holds counts and words, never texts."""
    ready = prepare_corpus(df)
    length = F.col("text_len")
    sources = small_side(
        ready.groupBy("source").agg(
            F.count("*").alias("rows"),
            F.sum(length).alias("_chars"),
            F.min(length).alias("_min"),
            F.max(length).alias("_max"),
            count_where(length < P.SHORT_TEXT_MIN).alias("_short"),
            count_where(length > P.SUMMARY_LONG_MIN).alias("_long"),
            F.sum(entity_count(F.col("text"))).alias("_entities"),
        )
    )

    def total(name: str, combine=F.sum) -> Column:
        return F.coalesce(combine(name), F.lit(0))

    numbers = sources.agg(
        total("rows").alias("total_rows"),
        F.coalesce(F.round(F.sum("_chars") / F.sum("rows"), 2), F.lit(0.0)).alias("avg_text_len"),
        total("_min", F.min).alias("min_text_len"),
        total("_max", F.max).alias("max_text_len"),
        pct(total("_short"), total("rows")).alias("pct_short_texts"),
        pct(total("_long"), total("rows")).alias("pct_long_texts"),
        total("_entities").alias("html_entity_count"),
    )
    # Both rankings start from the counts per source and token, which Spark exchanges once.
    by_source = token_counts(ready, SUMMARY, "source")
    overall = by_source.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(global_terms)
    ranked = top_per_group(by_source, "source", source_terms, F.desc("n"), F.col("token"))

    def in_order(order: Column) -> Column:
        return F.array_sort(F.collect_list(F.struct(order, F.col("token"))))["token"]

    return side_by_side(
        [
            numbers,
            as_map(sources, "source", "rows", "source_distribution"),
            overall.agg(in_order((-F.col("n")).alias("o")).alias("top_keywords_global")),
            as_map(
                ranked.groupBy("source").agg(in_order(F.col("rank").alias("o")).alias("words")),
                "source", "words", "top_keywords_by_source",
            ),
        ]
    )


# Issues that the ranking looks at, with the column behind each.
RANKED_ISSUES = {
    "HTML artifacts": "html_pct",
    "short texts": "short_pct",
    "long texts": "long_pct",
    "duplicates": "duplicates_pct",
}


def issue_ranking(quality: DataFrame, limit: int = 3) -> DataFrame:
    """The largest quality issues over all sources of a :func:`source_quality` frame."""
    place = {issue: number for number, issue in enumerate(RANKED_ISSUES)}
    cells = F.array(
        *[
            F.struct(F.lit(issue).alias("issue"), F.lit(place[issue]).alias("_place"), F.col(column).alias("value"))
            for issue, column in RANKED_ISSUES.items()
        ]
    )
    return (
        quality.select("source", "rows", F.inline(cells))
        .where("value > 0")
        .orderBy(F.desc("value"), F.desc("rows"), "source", "_place")
        .limit(limit)
        .select("issue", "source", "value")
    )


def insights(quality: DataFrame) -> DataFrame:
    """Key numbers over a :func:`source_quality` frame, as one row."""
    source, rows = F.col("source"), F.col("rows")
    total = F.sum("rows")

    def share(condition: Column) -> Column:
        return pct(F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)), total, 1)

    bootstrap = share(source.startswith("topic_bootstrap_"))
    return quality.agg(
        total.alias("total_rows"),
        F.count("*").alias("sources"),
        share(source.startswith("huggingface_")).alias("huggingface_pct"),
        bootstrap.alias("bootstrap_pct"),
        (bootstrap >= 70.0).alias("mostly_bootstrap"),
        F.min_by("source", F.struct(-rows, source)).alias("top_source"),
        pct(F.max("rows"), total, 1).alias("top_source_pct"),
        F.min_by("source", F.struct(-F.col("avg_len"), source)).alias("longest_source"),
        F.max("max_len").alias("max_len"),
        F.coalesce(F.max(F.when(source.startswith("rss_"), F.col("html_pct"))), F.lit(0.0)).alias("rss_html_pct"),
    )


def source_hypotheses(df: DataFrame) -> DataFrame:
    """Numbers behind the standing hypotheses: dominant source and share of each family."""
    counts = source_distribution(df)
    source, rows = F.col("source"), F.col("rows")
    total = F.sum("rows")
    families = [
        pct(F.coalesce(F.sum(F.when(source.startswith(prefix), rows)), F.lit(0)), total, 1).alias(f"{prefix}pct")
        for prefix, *_ in S.SOURCE_FAMILIES
    ]
    return counts.agg(
        F.min_by("source", F.struct(-rows, source)).alias("dominant_source"),
        pct(F.max("rows"), total, 1).alias("dominant_pct"),
        F.count("*").alias("sources"),
        *families,
    )
