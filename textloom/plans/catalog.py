"""Registry of runnable queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its check where SQL can express one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            CHECKS[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Share rows out over all cores where the files give fewer splits than there are cores.

    Only a small table gets this shuffle; one with many splits is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


# Source names of the given documents, mapped to one name per family. Portable SQL.
SOURCE_CASE = """
CASE CAST(substr(source, 4, 9) AS INT) % 8
 WHEN 0 THEN 'huggingface_set_' || substr(source, 4, 9)
 WHEN 1 THEN 'stackexchange_tag_' || substr(source, 4, 9)
 WHEN 2 THEN 'rss_host' || substr(source, 4, 9) || '.example.com'
 WHEN 3 THEN 'topic_bootstrap_' || substr(source, 4, 9)
 WHEN 4 THEN 'kaggle_set_' || substr(source, 4, 9)
 WHEN 5 THEN 'boat_forum_' || substr(source, 4, 9)
 WHEN 6 THEN 'sailingforums'
 ELSE source END
"""

# Classes and keywords for the given documents: function words of their four languages.
KEYWORDS = {
    "de": ["der", "die", "und", "en"],
    "en": ["the", "of", "and", "en"],
    "es": ["que", "los", "des", "la"],
    "fr": ["le", "les", "des", "la", "que"],
}


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a corpus: id, text, label (the language), source."""
    documents = spread(table(spark, sf_dir, "documents"), "doc_id")
    return documents.select(
        "doc_id", F.col("doc_id").cast("string").alias("id"), "text", F.col("lang").alias("label"),
        F.expr(SOURCE_CASE).alias("source"),
    )
