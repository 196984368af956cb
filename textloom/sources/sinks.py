"""Writers for corpus tables, the review queue, task exports and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators import prepare


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def review_queue(df: DataFrame) -> DataFrame:
    """Queue rows: the label doubles as suggestion, the correction is still empty."""
    return df.select(
        "id", "text", "label", "confidence", "source",
        F.col("label").alias("suggested_label"),
        F.lit("").alias("corrected_label"),
    ).select(*prepare.QUEUE_COLUMNS)


def write_review_queue(queue: DataFrame, path: str) -> None:
    """CSV with every field quoted, so commas, quotes and line breaks in texts survive."""
    queue.select(*prepare.QUEUE_COLUMNS).write.mode("overwrite").csv(
        path, header=True, quoteAll=True, quote='"', escape='"', encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="",
    )


def label_studio_tasks(df: DataFrame) -> DataFrame:
    """One nested task per labelled row."""
    result = F.struct(
        F.lit("choices").alias("type"),
        F.struct(F.array("label").alias("choices")).alias("value"),
        F.lit("label").alias("from_name"),
        F.lit("text").alias("to_name"),
    )
    return prepare.prepare_labeled(df).select(
        "id",
        F.struct("text").alias("data"),
        F.array(F.struct(F.array(result).alias("result"))).alias("annotations"),
    )


def write_label_studio(df: DataFrame, path: str) -> None:
    """Task export as JSON Lines: one task per line instead of one array for everything."""
    label_studio_tasks(df).write.mode("overwrite").json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)
