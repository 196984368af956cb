"""Readers that turn landed files into rows of the raw corpus schema."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import patterns as P
from textloom.functions.source_names import dataset_slug, normalize_source, selection_name, tag_slug
from textloom.functions.text import collection_key, digest, strip
from textloom.operators import prepare
from textloom.operators.dedup import keep_first
from textloom.plans.session import small_side
from textloom.sources import records, threads
from textloom.sources.threads import CLASSIC_FORUM, MODERN_FORUM, AnchorRule  # noqa: F401

log = logging.getLogger(__name__)

REVIEW_QUEUE_SCHEMA = (
    "id string, text string, label string, confidence double, "
    "source string, suggested_label string, corrected_label string"
)
_FEED_SCHEMA = "title string, summary string, description string"
_QUESTIONS_SCHEMA = "items array<struct<title: string, tags: array<string>>>, has_more boolean"


def read_first_existing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet scan of the first path that exists: annotated before clean before raw."""
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of these tables exists: {', '.join(paths)}")


def read_review_queue(spark: SparkSession, path: str) -> DataFrame:
    """Review queue from CSV: header, quoted fields, line breaks within a field."""
    return records.read_csv(spark, path, REVIEW_QUEUE_SCHEMA)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV table with string columns; types are not inferred, which would read it twice."""
    return records.read_csv(spark, path)


def stamp(rows: DataFrame, source: str | Column) -> DataFrame:
    """Raw-corpus rows from texts: unlabelled, with their source and the time of collection."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return rows.withColumns(
        {
            "source": F.lit(source) if isinstance(source, str) else source,
            "label": F.lit(prepare.UNLABELED),
            "collected_at": F.concat(now, F.lit("+00:00")),
        }
    )


def text_column_profile(df: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per string column: does it hold free text?

    Free text means: the first 20 non-null values are longer than 20 characters on average, and
    distinct values make up more than 0.3 of all rows. Distinct values are counted as
    aggregates over (column, value digest) pairs, so no column's values meet in one task.
    """
    names = [item.name for item in df.schema.fields if isinstance(item.dataType, T.StringType)]
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column_name string, avg_len double, unique_ratio double, is_text boolean"
        )
    cells = df.select(
        F.inline(F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").alias("value")) for name in names]))
    )
    distinct = cells.groupBy("column_name").agg(
        F.count("*").alias("rows"), F.countDistinct(digest(F.col("value"))).alias("values")
    )
    heads = None
    for name in names:
        head = (
            df.where(F.col(f"`{name}`").isNotNull())
            .orderBy(*order_by)
            .limit(20)
            .select(F.lit(name).alias("column_name"), F.length(f"`{name}`").alias("len"))
        )
        heads = head if heads is None else heads.unionAll(head)
    means = heads.groupBy("column_name").agg(F.avg("len").alias("avg_len"))
    ratio = F.col("values") / F.col("rows")
    return distinct.join(means, "column_name", "left").select(
        "column_name",
        "avg_len",
        ratio.alias("unique_ratio"),
        F.coalesce((F.col("avg_len") > 20) & (ratio > 0.3), F.lit(False)).alias("is_text"),
    )


def detect_text_column(df: DataFrame, order_by: list[str], preferred: str | None = "text") -> str | None:
    """The preferred column if it holds free text, else the first string column that does."""
    is_text = {row["column_name"]: row["is_text"] for row in text_column_profile(df, order_by).collect()}
    if preferred and is_text.get(preferred):
        return preferred
    return next((name for name in df.columns if is_text.get(name)), None)


def ingest_table(
    df: DataFrame, name: str, order_by: list[str], preferred: str | None = "text", limit: int | None = None
) -> DataFrame | None:
    """Landed dataset: its text column, the first ``limit`` rows, source ``huggingface_<slug>``.

    ``None`` when no column holds free text.
    """
    column = detect_text_column(df, order_by, preferred)
    if column is None:
        return None
    rows = df if limit is None else df.orderBy(*order_by).limit(limit)
    return stamp(rows.select(F.col(f"`{column}`").alias("text")), F.concat(F.lit("huggingface_"), dataset_slug(F.lit(name))))


def ingest_csv(
    df: DataFrame, reference: str, order_by: list[str], preferred: str | None = None, limit: int | None = None
) -> DataFrame | None:
    """Landed CSV: limit first, if one is given, then detection on those rows; source ``kaggle_<last part>``."""
    rows = df if limit is None else df.orderBy(*order_by).limit(limit)
    column = detect_text_column(rows, order_by, preferred)
    if column is None or preferred not in (None, column):
        return None
    text = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("nan"))
    return with_id(stamp(rows.select(text.alias("text")), f"kaggle_{reference.split('/')[-1]}"))


def feed_rows(items: DataFrame, source: Column) -> DataFrame:
    """Feed entries with ``title`` and ``summary``: joined by a full stop, 20 characters or more."""
    joined = F.concat(
        F.coalesce(F.col("title"), F.lit("")), F.lit(". "), F.coalesce(F.col("summary"), F.lit(""))
    )
    text = strip(F.btrim(joined, F.lit(". ")))
    rows = items.select(text.alias("text"), source.alias("source")).where(F.length("text") >= P.COLLECT_MIN)
    return stamp(rows, F.col("source"))


def ingest_feed(spark: SparkSession, path: str, url: str, row_tag: str = "item") -> DataFrame:
    """Landed feed XML. RSS ``description`` is what feed readers present as the summary."""
    items = (
        spark.read.format("xml").option("rowTag", row_tag).schema(_FEED_SCHEMA).load(path)
        .withColumn("summary", F.coalesce("summary", "description"))
    )
    host = F.try_parse_url(F.lit(url), F.lit("AUTHORITY"))
    return feed_rows(items, F.concat(F.lit("rss_"), host))


def ingest_questions(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """Landed Q&A pages: title and tags of every item, 20 characters or more."""
    pages = spark.read.schema(_QUESTIONS_SCHEMA).json(path, multiLine=True)
    return question_rows(pages.select(F.inline("items")), tag)


def question_rows(items: DataFrame, tag: str) -> DataFrame:
    tags = F.array_join(F.coalesce(F.col("tags"), F.array().cast("array<string>")), " ")
    title = F.coalesce(F.col("title"), F.lit(""))
    text = F.when(tags != "", strip(F.concat_ws(" ", title, tags))).otherwise(title)
    rows = items.select(text.alias("text")).where(F.length("text") >= P.COLLECT_MIN)
    return stamp(rows, F.concat(F.lit("stackexchange_"), tag_slug(F.lit(tag))))


def thread_titles(
    pages: DataFrame, rule: AnchorRule, source: str, html_col: str = "html", min_length: int = P.COLLECT_MIN
) -> DataFrame:
    """Thread titles from forum pages.

    The cut to the first ``rule.limit`` links comes before the length test.
    """
    return stamp(threads.with_titles(pages, rule, html_col, min_length), source)


def selected_sources(rows: DataFrame, selection: Sequence[str], alias: Column | None = None) -> DataFrame:
    """Rows whose source is on the allow-list; an empty list allows every source.

    List entries and names are compared in normalised form, entries by their last part.
    """
    entries = [entry for entry in selection if str(entry).strip()]
    if not entries:
        return rows
    spark = rows.sparkSession
    wanted = (
        spark.createDataFrame([(entry,) for entry in entries], "entry string")
        .select(selection_name(F.col("entry")).alias("_name"))
        .where("_name <> ''")
        .distinct()
    )
    name = normalize_source(F.col("source") if alias is None else alias)
    return rows.withColumn("_name", name).join(small_side(wanted), "_name", "left_semi").drop("_name")


def with_id(rows: DataFrame) -> DataFrame:
    """Ids that survive a new collection: a digest of source and text."""
    return rows.withColumn("id", F.md5(F.concat(F.col("source"), F.lit("\u0001"), F.col("text"))))


def merge(sources: Sequence[DataFrame], order_by: Sequence[str] = ()) -> DataFrame:
    """Union of collected sources, deduplicated, length-filtered, with ids, raw schema.

    Which copy of a text survives is settled by the place of its source in the list, then by
    the given columns and finally by source and text.
    """
    if not sources:
        raise ValueError("merge needs at least one source")
    union = None
    for priority, rows in enumerate(sources):
        ranked = rows.withColumn("_priority", F.lit(priority))
        union = ranked if union is None else union.unionByName(ranked, allowMissingColumns=True)
    if "id" in union.columns and "id" not in order_by:
        union = union.drop("id")
    kept = keep_first(union, collection_key(F.col("text")), ["_priority", *order_by, "source", "text"])
    return prepare.conform_raw(with_id(prepare.filter_collected(kept)))


def available(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sources that can be read. One that cannot be found or opened is left out, with a warning.

    Any other failure, such as that of a job, is raised.
    """
    usable = {}
    for name, rows in sources.items():
        try:
            rows.limit(1).count()
        except (AnalysisException, Py4JJavaError) as error:
            if isinstance(error, Py4JJavaError) and "FAILED_READ_FILE" not in str(error):
                raise
            log.warning("source %s cannot be read and is left out: %s", name, str(error).partition("\n")[0])
            continue
        usable[name] = rows
    return usable


def collection_metrics(merged: DataFrame) -> DataFrame:
    """Rows and average text length, per source and in total (source ``*``)."""
    counts = merged.groupBy("source").agg(
        F.count("*").alias("rows"), F.sum(F.length("text")).cast("bigint").alias("chars")
    )
    return (
        counts.groupingSets([["source"], []], "source")
        .agg(F.sum("rows").alias("rows"), F.round(F.sum("chars") / F.sum("rows"), 1).alias("avg_len"), F.grouping("source").alias("_all"))
        .select(F.when(F.col("_all") == 1, "*").otherwise(F.col("source")).alias("source"), "rows", "avg_len")
    )
