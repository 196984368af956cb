"""Projections and row filters that bring a frame into the shape the next step expects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import patterns as P
from textloom.functions.numbers import to_double
from textloom.functions.text import collapse_whitespace, is_blank, strip
from textloom.operators.dedup import with_position
from textloom.plans.session import small_side

RAW_COLUMNS = ("id", "text", "label", "source", "collected_at")
QUEUE_COLUMNS = ("id", "text", "label", "confidence", "source", "suggested_label", "corrected_label")
# Fixed values.
UNLABELED = "unlabeled"
REVIEW_LABEL = "other_or_offtopic"
FALLBACK = "fallback"


def require(df: DataFrame, *columns: str) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s): {', '.join(missing)}")


def string_or(df: DataFrame, name: str, default: str) -> Column:
    """The column as a non-null string; the default where it is null or absent."""
    if name not in df.columns:
        return F.lit(default)
    return F.coalesce(F.col(name).cast("string"), F.lit(default))


def conform_raw(df: DataFrame) -> DataFrame:
    """Exactly the five raw columns, in order, absent ones null."""
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast("string").alias(name)
            for name in RAW_COLUMNS
        ]
    )


def prepare_quality(df: DataFrame) -> DataFrame:
    """Require a text column, make it a non-null string, default the label column."""
    require(df, "text")
    df = df.withColumn("text", string_or(df, "text", ""))
    return df if "label" in df.columns else df.withColumn("label", F.lit(UNLABELED))


def prepare_annotation(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """As :func:`prepare_quality`, plus string ids and a non-null source.

    A frame without ids gets its 1-based position in ``order_by`` as id.
    """
    require(df, "text")
    df = df.withColumn("text", string_or(df, "text", ""))
    if "id" in df.columns:
        df = df.withColumn("id", string_or(df, "id", ""))
    else:
        if not order_by:
            raise ValueError("a frame without an id column needs order_by to number its rows")
        df = numbered(df, order_by)
    return df.withColumn("source", string_or(df, "source", "unknown"))


def prepare_labeled(
    df: DataFrame, review_label: str = REVIEW_LABEL, order_by: list[str] | None = None
) -> DataFrame:
    """Annotated frame with every annotation column present and non-null."""
    df = prepare_annotation(df, order_by)
    confidence = to_double(F.col("confidence")) if "confidence" in df.columns else F.lit(0.0)
    return df.withColumns(
        {
            "label": string_or(df, "label", review_label),
            "confidence": confidence,
            "label_source": string_or(df, "label_source", FALLBACK),
        }
    )


def prepare_training(df: DataFrame) -> DataFrame:
    """Labelled rows for active learning: text and label non-blank."""
    require(df, "text", "label")
    df = df.withColumns({"text": string_or(df, "text", ""), "label": string_or(df, "label", "")})
    return df.where(~is_blank(F.col("text")) & ~is_blank(F.col("label")))


def prepare_pool(df: DataFrame, order_by: list[str] | None = None, id_col: str = "id") -> DataFrame:
    """Unlabelled pool: a non-blank correction wins over the label; blank texts are dropped."""
    require(df, "text")
    label = string_or(df, "label", "")
    if "corrected_label" in df.columns:
        correction = strip(string_or(df, "corrected_label", ""))
        label = F.when(correction != "", correction).otherwise(label)
    df = df.withColumns({"text": string_or(df, "text", ""), "label": label})
    df = df.where(~is_blank(F.col("text")))
    if id_col not in df.columns:
        if not order_by:
            raise ValueError("a pool without an id column needs order_by to number its rows")
        df = numbered(df, order_by, id_col)
    return df


def numbered(df: DataFrame, order_by: list[str], id_col: str = "id") -> DataFrame:
    """Add the 1-based position as a string id."""
    return with_position(df, order_by, "_pos").withColumn(id_col, (F.col("_pos") + 1).cast("string")).drop("_pos")


def labelled_only(df: DataFrame, review_label: str = REVIEW_LABEL) -> DataFrame:
    """Annotated rows as active learning loads them: neither unlabelled nor for review."""
    label = string_or(df, "label", "None")
    return df.where((label != UNLABELED) & (label != review_label))


def trainable_rows(
    df: DataFrame,
    text_col: str = "text",
    label_col: str = "label",
    review_label: str | None = REVIEW_LABEL,
) -> DataFrame:
    """Rows a classifier may train on. ``review_label=None`` keeps the review class."""
    require(df, text_col, label_col)
    df = df.withColumns({text_col: string_or(df, text_col, ""), label_col: string_or(df, label_col, "")})
    keep = (F.col(label_col) != UNLABELED) & ~is_blank(F.col(text_col))
    if review_label is not None:
        keep = keep & (F.col(label_col) != review_label)
    return df.where(keep)


def valid_classes(df: DataFrame, label_col: str = "label") -> list[str]:
    """Labels that stay after the rare-class rule, sorted.

    Classes with a single row go, but only where at least two larger classes remain. The list
    belongs to the model (one coefficient row per class), so it lives on the driver.
    """
    counts = {row[0]: row[1] for row in df.groupBy(label_col).count().collect()}
    valid = [label for label, rows in counts.items() if rows >= 2]
    return sorted(valid if 2 <= len(valid) < len(counts) else counts)


def drop_rare_classes(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows of the labels that :func:`valid_classes` keeps, found without the driver."""
    counts = small_side(df.groupBy(label_col).agg(F.count("*").alias("_rows")))
    rare_go = counts.agg(F.count_if(F.col("_rows") >= 2) >= 2).scalar()
    return df.join(counts.where((F.col("_rows") >= 2) | ~rare_go).select(label_col), label_col, "left_semi")


def handle_missing(df: DataFrame, strategy: str = "drop") -> DataFrame:
    """``drop`` rows with a null in any column, ``fill`` string nulls with ``''``, or keep."""
    if strategy == "drop":
        return df.na.drop("any")
    return df.na.fill("") if strategy == "fill" else df


def filter_collected(df: DataFrame, low: int = P.COLLECT_MIN, high: int = P.COLLECT_MAX) -> DataFrame:
    return df.where(F.length("text").between(low, high))


def handle_short(df: DataFrame, strategy: str = "filter", minimum: int = P.SHORT_TEXT_MIN) -> DataFrame:
    return df.where(F.length("text") >= minimum) if strategy == "filter" else df


def handle_long(df: DataFrame, strategy: str = "truncate", maximum: int = P.LONG_TEXT_MAX) -> DataFrame:
    if strategy == "truncate":
        return df.withColumn("text", F.substring("text", 1, maximum))
    return df.where(F.length("text") <= maximum) if strategy == "filter" else df


def finish_text(df: DataFrame) -> DataFrame:
    """Collapse white space and drop texts that are blank afterwards."""
    return df.withColumn("text", collapse_whitespace(F.col("text"))).where("text <> ''")


def page(df: DataFrame, number: int, order_by: list[str], size: int = 10) -> DataFrame:
    """Page ``number`` (from 1) of a listing."""
    return df.orderBy(*order_by).offset((max(number, 1) - 1) * size).limit(size)
