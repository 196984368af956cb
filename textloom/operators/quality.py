"""Quality profile, cleaning and before/after comparison."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import patterns as P
from textloom.functions.numbers import count_where, pct
from textloom.functions.text import (
    decode_basic_entities,
    decode_entities,
    dedup_key,
    has_artifact,
    has_markup,
    remove_markup,
)
from textloom.operators import prepare
from textloom.operators.dedup import (
    drop_fuzzy_duplicates,
    duplicate_count,
    fuzzy_pairs,
    keep_first,
    with_position,
)
from textloom.operators.frames import as_map, side_by_side

# The default cleaning strategy.
DEFAULT_STRATEGY = {
    "html_entities": "decode",
    "html_artifacts": "remove",
    "duplicates": "drop",
    "fuzzy_duplicates": "remove",
    "short_texts": "filter",
    "long_texts": "truncate",
    "missing": "drop",
}


def issue_counts(words: tuple[str, ...] = P.ARTIFACT_WORDS) -> list[Column]:
    """Aggregates of the profile that need one pass over the texts."""
    text = F.col("text")
    length = F.length(text)
    return [
        F.count("*").alias("total_rows"),
        duplicate_count(dedup_key(text), blank_counts=False).alias("duplicates"),
        count_where(length < P.SHORT_TEXT_MIN).alias("short_texts"),
        count_where(length > P.LONG_TEXT_MAX).alias("long_texts"),
        count_where(has_markup(text)).alias("html_entities"),
        count_where(has_artifact(text, words)).alias("html_artifacts"),
        F.sum(length).cast("bigint").alias("total_length"),
    ]


def _missing_counts(df: DataFrame) -> list[Column]:
    """Aggregates: null cells per column, as ``_missing<i>``. NaN counts as null."""
    kinds = dict(df.dtypes)

    def absent(name: str) -> Column:
        cell = F.col(f"`{name}`")
        return cell.isNull() | F.isnan(cell) if kinds[name] in ("float", "double") else cell.isNull()

    return [count_where(absent(name)).alias(f"_missing{i}") for i, name in enumerate(df.columns)]


def _missing_summary(names: list[str]) -> list[Column]:
    counts = [F.col(f"_missing{i}") for i in range(len(names))]
    hit = F.array(*[F.when(count > 0, F.lit(name)) for count, name in zip(counts, names)])
    return [
        sum(counts, F.lit(0)).cast("bigint").alias("missing_count"),
        F.array_compact(hit).alias("missing_columns"),
    ]


def missing_cells(df: DataFrame) -> DataFrame:
    """One row: null cells in total, and the names of columns that hold any.

    Text is made non-null first, so it never counts.
    """
    df = prepare.prepare_quality(df)
    return df.agg(*_missing_counts(df)).select(*_missing_summary(df.columns))


def _word_flags(words: tuple[str, ...]) -> list[Column]:
    """Aggregates: does each artifact word occur anywhere, as ``_word<i>``."""
    lower = F.lower(F.col("text"))
    return [F.max(F.contains(lower, F.lit(word))).alias(f"_word{i}") for i, word in enumerate(words)]


def _words_seen(words: tuple[str, ...]) -> Column:
    hits = [F.when(F.col(f"_word{i}"), F.lit(word)) for i, word in enumerate(words)]
    return F.array_sort(F.array_compact(F.array(*hits).cast("array<string>"))).alias("patterns")


def artifact_hits(df: DataFrame, words: tuple[str, ...] = P.ARTIFACT_WORDS) -> DataFrame:
    """One row: the artifact words that occur anywhere, sorted and distinct."""
    return prepare.prepare_quality(df).agg(*_word_flags(words)).select(_words_seen(words))


def label_distribution(df: DataFrame, column: str = "label", default: str = "") -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(prepare.string_or(df, column, default).alias(column))
        .agg(F.count("*").alias("rows"))
        .orderBy(F.desc("rows"), column)
    )


def imbalance_ratio(distribution: DataFrame) -> DataFrame:
    """Largest class over smallest; the class size itself when there is only one class."""
    low, high = F.min("rows"), F.max("rows")
    ratio = (
        F.when(F.count("*") == 0, 0.0)
        .when(F.count("*") == 1, high.cast("double"))
        .otherwise(F.round(high / low, 2))
    )
    return distribution.where("rows > 0").agg(ratio.alias("imbalance_ratio"))


def markup_examples(df: DataFrame, order_by: list[str], count: int = 3, width: int = 150) -> DataFrame:
    """The first texts with markup, cut for display."""
    df = prepare.prepare_quality(df)
    return (
        df.where(has_markup(F.col("text")))
        .orderBy(*order_by)
        .limit(count)
        .withColumn("text", F.substring("text", 1, width))
    )


def find_fuzzy_duplicates(
    df: DataFrame, order_by: list[str], threshold: float = P.FUZZY_THRESHOLD
) -> DataFrame:
    """Near-duplicate pairs of a frame: positions, cut texts and similarity."""
    rows = prepare.prepare_quality(df).select("text", *[name for name in order_by if name != "text"])
    return fuzzy_pairs(with_position(rows, order_by), threshold=threshold)


def detect_issues(
    df: DataFrame,
    order_by: list[str],
    words: tuple[str, ...] = P.ARTIFACT_WORDS,
    threshold: float = P.FUZZY_THRESHOLD,
    fuzzy: bool = True,
) -> DataFrame:
    """The quality report as one row; without ``fuzzy`` near duplicates are not looked for.

    All counts over the texts come from one aggregate. The other parts are aggregates of one
    row as well; they meet in a union and a final aggregate, so no part is joined to another.
    """
    ready = prepare.prepare_quality(df)
    labels = label_distribution(ready)
    counts = ready.agg(*issue_counts(words), *_missing_counts(ready), *_word_flags(words))
    kept = [name for name in counts.columns if not name.startswith("_")]
    parts = [
        counts.select(*kept, *_missing_summary(ready.columns), _words_seen(words)),
        imbalance_ratio(labels),
        as_map(labels, "label", "rows", "label_distribution"),
        markup_examples(df, order_by).agg(
            F.array_sort(F.collect_list(F.struct(*order_by, "text")))["text"].alias("html_examples")
        ),
    ]
    if fuzzy:
        parts.append(find_fuzzy_duplicates(df, order_by, threshold).agg(F.count("*").alias("fuzzy_pairs")))
    report = side_by_side(parts)
    if not fuzzy:
        report = report.withColumn("fuzzy_pairs", F.lit(0).cast("bigint"))
    total = F.col("total_rows")
    issues = ["missing_count", "duplicates", "fuzzy_pairs", "short_texts", "long_texts", "html_entities", "html_artifacts"]
    found = sum((F.when(F.col(name) > 0, 1).otherwise(0) for name in issues), F.lit(0))
    return report.select(
        "total_rows",
        "missing_count",
        "missing_columns",
        "duplicates",
        pct(F.col("duplicates"), total).alias("duplicates_pct"),
        "fuzzy_pairs",
        F.lit(float(threshold)).alias("fuzzy_threshold"),
        "short_texts",
        pct(F.col("short_texts"), total).alias("short_pct"),
        "long_texts",
        pct(F.col("long_texts"), total).alias("long_pct"),
        "html_entities",
        pct(F.col("html_entities"), total).alias("html_pct"),
        "html_examples",
        "html_artifacts",
        "patterns",
        "label_distribution",
        "imbalance_ratio",
        (found + F.when(F.col("imbalance_ratio") > 1, 1).otherwise(0)).cast("bigint").alias("issues_found"),
    )


def clean(
    df: DataFrame,
    order_by: list[str],
    strategy: Mapping[str, str] | None = None,
    words: tuple[str, ...] = P.ARTIFACT_WORDS,
    threshold: float = P.FUZZY_THRESHOLD,
    basic_entities: bool = False,
) -> DataFrame:
    """Apply the cleaning steps in their fixed order.

    Missing values, entities, markup, exact duplicates, near duplicates, short texts, long
    texts, white space. ``order_by`` decides which copy is the first one and must be total;
    it may only use columns other than the text, because the text changes on the way.
    """
    plan = {**DEFAULT_STRATEGY, **(strategy or {})}
    df = prepare.handle_missing(prepare.prepare_quality(df), plan["missing"])
    text = F.col("text")
    if plan["html_entities"] == "decode":
        decode = decode_basic_entities if basic_entities else decode_entities
        df = df.withColumn("text", decode(text))
    if plan["html_artifacts"] == "remove":
        df = df.withColumn("text", remove_markup(text, words))
    if plan["duplicates"] == "drop":
        df = keep_first(df, dedup_key(text), order_by)
    if plan["fuzzy_duplicates"] == "remove":
        # Staged once: pairs and survivors read the same rows and positions.
        rows = with_position(df, order_by, "_pos")
        pairs = fuzzy_pairs(rows, pos_col="_pos", threshold=threshold)
        df = drop_fuzzy_duplicates(rows, pairs, "_pos").drop("_pos")
    df = prepare.handle_short(df, plan["short_texts"])
    df = prepare.handle_long(df, plan["long_texts"])
    return prepare.finish_text(df)


def compare(
    before: DataFrame, after: DataFrame, order_by: list[str], threshold: float = P.FUZZY_THRESHOLD
) -> DataFrame:
    """One row with the main quality counts on both sides of the cleaning.

    Each side is read twice; pass ``after`` as a written table, not as the cleaning itself.
    """

    def side(df: DataFrame, suffix: str) -> list[DataFrame]:
        counts = prepare.prepare_quality(df).agg(*issue_counts())
        pairs = find_fuzzy_duplicates(df, order_by, threshold).agg(F.count("*").alias(f"fuzzy_duplicates_{suffix}"))
        return [counts.select([F.col(name).alias(f"{name}_{suffix}") for name in counts.columns]), pairs]

    both = side_by_side(side(before, "before") + side(after, "after"))
    rows_before, rows_after = F.col("total_rows_before"), F.col("total_rows_after")

    def mean_length(suffix: str) -> Column:
        mean = F.col(f"total_length_{suffix}") / F.nullif(F.col(f"total_rows_{suffix}"), F.lit(0))
        return F.coalesce(F.round(mean, 2), F.lit(0.0)).alias(f"avg_len_{suffix}")

    return both.select(
        rows_before.alias("rows_before"),
        rows_after.alias("rows_after"),
        (rows_before - rows_after).alias("rows_removed"),
        pct(rows_before - rows_after, rows_before).alias("pct_removed"),
        *[
            F.col(f"{name}_{suffix}")
            for name in ("html_entities", "short_texts", "duplicates", "fuzzy_duplicates")
            for suffix in ("before", "after")
        ],
        mean_length("before"),
        mean_length("after"),
    )


def metric_rows(comparison: DataFrame) -> DataFrame:
    """The comparison as rows ``metric, before, after, improvement``."""
    # Metric titles and the columns behind them.
    metrics = {
        "HTML entities": "html_entities",
        "Short texts": "short_texts",
        "Duplicates": "duplicates",
        "Fuzzy duplicate pairs": "fuzzy_duplicates",
    }
    rows = [
        F.struct(
            F.lit("Rows").alias("metric"),
            F.col("rows_before").cast("double").alias("before"),
            F.col("rows_after").cast("double").alias("after"),
            (F.col("rows_after") - F.col("rows_before")).cast("double").alias("improvement"),
        )
    ]
    for title, name in metrics.items():
        first, last = F.col(f"{name}_before").cast("double"), F.col(f"{name}_after").cast("double")
        rows.append(
            F.struct(
                F.lit(title).alias("metric"), first.alias("before"), last.alias("after"),
                (first - last).alias("improvement"),
            )
        )
    first, last = F.col("avg_len_before"), F.col("avg_len_after")
    rows.append(
        F.struct(
            F.lit("Average text length").alias("metric"), first.alias("before"), last.alias("after"),
            F.round(last - first, 2).alias("improvement"),
        )
    )
    return comparison.select(F.inline(F.array(*rows)))
