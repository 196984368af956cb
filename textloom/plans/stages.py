"""Stages of the given documents that several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import labelling
from textloom.plans.catalog import KEYWORDS, corpus, table
from textloom.plans.session import staged


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with automatic labels; the language is kept as ``truth``."""
    rows = corpus(spark, sf_dir).withColumnRenamed("label", "truth")
    return labelling.auto_label(rows, KEYWORDS)


def annotated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotated table as a file: filters on the labels then read it instead of pushing the
    labelling expressions into every scan."""
    return staged(annotated(spark, sf_dir), "annotated")


def queue(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Low-confidence rows; labelled documents of good quality carry a correction, toxic ones
    a blank one."""
    low = labelling.split_by_confidence(annotated_table(spark, sf_dir) if rows is None else rows)[1]
    labels = table(spark, sf_dir, "labels")
    correction = F.when(F.col("quality") == 1, F.col("truth")).when(F.col("toxic") == 1, "  ").otherwise("")
    return low.join(labels, "doc_id", "left").select(
        "id", "text", "label", "confidence", "source", F.col("label").alias("suggested_label"),
        correction.alias("corrected_label"),
    )
