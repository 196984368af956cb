"""Queries over readers, writers and the collection step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.source_names import feed_display_name, url_host
from textloom.operators import prepare, quality
from textloom.plans import sql as S
from textloom.plans.catalog import corpus, query, spread, table
from textloom.plans.session import stage_path, staged
from textloom.plans.stages import annotated, queue
from textloom.sources import ingest, sinks


@query("SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang")
def preferred_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First existing of several tables; here only the last one exists."""
    paths = [f"{sf_dir}/{name}.parquet" for name in ("annotated", "dataset_clean", "documents")]
    rows = ingest.read_first_existing(spark, paths)
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query(f"""WITH {S.QUEUE} SELECT id, md5(text) AS text_md5, label, confidence, source, suggested_label,
 nullif(corrected_label, '') AS corrected_label FROM queue""")
def review_queue_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review queue written as CSV and read back, line breaks and quotes included."""
    path = stage_path(spark, "queue-csv")
    sinks.write_review_queue(queue(spark, sf_dir), path)
    rows = ingest.read_review_queue(spark, path)
    return rows.select(
        "id", F.md5("text").alias("text_md5"), "label", "confidence", "source", "suggested_label",
        F.nullif("corrected_label", F.lit("")).alias("corrected_label"),
    )


@query(f"""WITH {S.ANNOTATED} SELECT id, md5(text) AS text_md5, 'choices' AS type, label AS choice,
 'label' AS from_name, 'text' AS to_name FROM annotated""")
def label_studio_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested annotation tasks written as JSON lines, read back and flattened."""
    path = stage_path(spark, "tasks")
    rows = annotated(spark, sf_dir)
    sinks.write_label_studio(rows, path)
    tasks = spark.read.schema(sinks.label_studio_tasks(rows).schema).json(path)
    result = F.col("annotations")[0]["result"][0]
    return tasks.select(
        "id", F.md5("data.text").alias("text_md5"), result["type"].alias("type"),
        result["value"]["choices"][0].alias("choice"), result["from_name"].alias("from_name"),
        result["to_name"].alias("to_name"),
    )


@query("""WITH u AS (SELECT text, 'benchmark' AS source FROM benchmark UNION ALL SELECT text, role FROM conversations)
 SELECT NULL::VARCHAR AS id, text, NULL::VARCHAR AS label, source, NULL::VARCHAR AS collected_at FROM u""")
def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables brought to the raw schema, written as Parquet and read back."""
    path = stage_path(spark, "raw")
    first = table(spark, sf_dir, "benchmark").select("text", F.lit("benchmark").alias("source"))
    second = table(spark, sf_dir, "conversations").select(F.col("role").alias("source"), "text")
    sinks.write_table(prepare.conform_raw(first.unionByName(second)), path)
    return spark.read.parquet(path)


@query("""WITH cells AS (SELECT 'text' AS column_name, text AS value, doc_id FROM documents
   UNION ALL SELECT 'lang', lang, doc_id FROM documents UNION ALL SELECT 'source', source, doc_id FROM documents),
 heads AS (SELECT column_name, value FROM cells WHERE value IS NOT NULL
   QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY doc_id) <= 20),
 means AS (SELECT column_name, avg(length(value)) AS avg_len FROM heads GROUP BY 1),
 ratios AS (SELECT column_name, count(DISTINCT value) / count(*) AS unique_ratio FROM cells GROUP BY 1)
 SELECT column_name, round(avg_len, 6) AS avg_len, round(unique_ratio, 6) AS unique_ratio,
   avg_len > 20 AND unique_ratio > 0.3 AS is_text FROM means JOIN ratios USING (column_name)""")
def text_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which string columns of the documents hold free text."""
    profile = ingest.text_column_profile(table(spark, sf_dir, "documents"), ["doc_id"])
    return profile.withColumns({name: F.round(name, 6) for name in ("avg_len", "unique_ratio")})


@query("""SELECT text, 'huggingface_given_conversations' AS source, 'unlabeled' AS label
 FROM conversations ORDER BY conv_id, turn LIMIT 300""")
def table_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset ingest: the wanted column is no free text, so another one is found; first rows only."""
    rows = ingest.ingest_table(
        table(spark, sf_dir, "conversations"), "given/conversations", ["conv_id", "turn"], preferred="role", limit=300
    )
    return rows.select("text", "source", "label")


@query("""SELECT text, 'kaggle_benchmark' AS source, md5('kaggle_benchmark' || chr(1) || text) AS id FROM (
 SELECT text FROM benchmark ORDER BY item_id::VARCHAR LIMIT 200)""")
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV ingest with a row limit and a detected text column."""
    path = stage_path(spark, "csv")
    table(spark, sf_dir, "benchmark").write.csv(path, header=True, quoteAll=True, escape='"')
    rows = ingest.ingest_csv(ingest.read_csv(spark, path), "given/benchmark", ["item_id"], limit=200)
    return rows.select("text", "source", "id")


_FEED_TEXT = (
    "CASE WHEN doc_id % 3 = 0 THEN text || '. ' "
    "ELSE split_part(text, chr(10), 1) || '. ' || text END"
)


@query(f"""WITH t AS (SELECT {S.strip(f"trim({_FEED_TEXT}, '. ')")} AS text FROM documents)
 SELECT md5(text) AS text_md5, length(text) AS chars, 'rss_www.example.com:8080' AS source FROM t WHERE length(text) >= 20""")
def feed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed XML made from the documents: first line as title; every third one has all its text there and no summary."""
    path = stage_path(spark, "feed")
    title = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.split_part("text", F.lit("\n"), F.lit(1)))
    documents = table(spark, sf_dir, "documents")
    documents.select(
        title.alias("title"), F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("description")
    ).write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    rows = ingest.ingest_feed(spark, path, "https://www.example.com:8080/feed")
    return rows.select(F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("chars"), "source")


@query(f"""WITH t AS (SELECT CASE WHEN doc_id % 5 = 0 THEN {S.strip("text")}
   ELSE {S.strip("text || ' ' || lang || ' ' || source")} END AS text FROM documents)
 SELECT text, 'stackexchange_sail_boats' AS source FROM t WHERE length(text) >= 20""")
def question_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q&A pages of up to 100 items made from the documents; every fifth item has no tags."""
    path = stage_path(spark, "questions")
    tags = F.when(F.col("doc_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array("lang", "source"))
    item = F.struct(F.col("text").alias("title"), tags.alias("tags"))
    pages = (
        table(spark, sf_dir, "documents")
        .groupBy(F.floor(F.col("doc_id") / 100).alias("page"))
        .agg(F.collect_list(item).alias("items"))
        .select("items", F.lit(True).alias("has_more"))
    )
    # A page is a file of its own, as it is landed.
    pages.write.option("maxRecordsPerFile", 1).json(path)
    return ingest.ingest_questions(spark, path, "Sail & Boats").select("text", "source")


_LINKS = r'<a href="([^"]*)">([^<]*)</a>'


@query(f"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, {S.text(_LINKS)}, 1)) AS href,
   unnest(regexp_extract_all(html, {S.text(_LINKS)}, 2)) AS title, generate_subscripts(regexp_extract_all(html, {S.text(_LINKS)}), 1) AS place FROM pages),
 r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY place) AS rn FROM a WHERE contains(href, 'e'))
 SELECT page_id, {S.strip('title')} AS text, 'page_links' AS source FROM r WHERE rn <= 15 AND length({S.strip('title')}) >= 5""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the pages by address; the link cut comes before the length test."""
    rule = ingest.AnchorRule(href_parts=("e",), limit=15)
    rows = ingest.thread_titles(table(spark, sf_dir, "pages"), rule, "page_links", min_length=5)
    return rows.select("page_id", "text", "source")


_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


def _forum_pages(spark: SparkSession, sf_dir: str, most: int, item: str) -> DataFrame:
    """Forum pages with up to ``most`` items that carry the titles of the given pages; ``item`` is SQL of ``title`` and ``i``."""
    titled = table(spark, sf_dir, "pages").selectExpr("page_id", f"{_TITLE} AS title")
    body = f"array_join(transform(sequence(1L, page_id % {most} + 1), i -> {item}), '')"
    return staged(titled.selectExpr("page_id", f"concat('<html><body><table><tr>', {body}, '</tr></table></body></html>') AS html"), "forum")


_TITLE_TEXT = "replace(replace(replace(replace(replace(title, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"


@query(f"""WITH t AS (SELECT page_id, {_TITLE} AS title FROM pages),
 d AS (SELECT page_id, {_TITLE_TEXT} AS title, unnest(generate_series(1, least(15, page_id % 23 + 1))) AS i FROM t),
 r AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN {S.strip('title')} || 'no. ' ELSE title || ' no. ' END || i AS text FROM d)
 SELECT page_id, {S.strip('text')} AS text, 'cruisers_forum' AS source FROM r WHERE length({S.strip('text')}) >= 20""")
def classic_forum_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thread titles of forum pages of the older kind: by class, by id, or by the fallback to addresses."""
    item = """CASE page_id % 3
      WHEN 0 THEN concat('<td><div>Sticky <a class="big title" href="/t/', i, '"><b>', title, '</b> no. ', i, '</a></div><a href="/last">To the last page of it</a></td>')
      WHEN 1 THEN concat('<td><a id="thread_title_', i, '" href="/t/', i, '">', title, ' no. ', i, '</a><!-- <a class="title">Nothing but a remark</a> --></td>')
      ELSE concat('<td><a href="/showthread.php?t=', i, '">', title, ' no. ', i, '</a> by <a href="/member">a member with a long name</a></td>') END"""
    rows = ingest.thread_titles(_forum_pages(spark, sf_dir, 23, item), ingest.CLASSIC_FORUM, "cruisers_forum")
    return rows.select("page_id", "text", "source")


@query(f"""WITH t AS (SELECT page_id, {_TITLE} AS title FROM pages),
 d AS (SELECT page_id, {_TITLE_TEXT} || ' no. ' || unnest(generate_series(1, least(40, page_id % 50 + 1))) AS text FROM t)
 SELECT page_id, {S.strip('text')} AS text, 'sailingforums' AS source FROM d WHERE length({S.strip('text')}) >= 20""")
def modern_forum_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thread titles of forum pages of the newer kind: by class, by address, and in containers that hold containers."""
    item = """concat('<li><div class="structItem">', CASE i % 4
      WHEN 0 THEN concat('<div class="x structItem-title"><div class="labels"><div>Hot</div><br></div><p><span><a href="/t">', title, ' no. ', i, '</a></span></div>')
      WHEN 1 THEN concat('<a href="/threads/', i, '">', title, ' no. ', i, '</a>')
      WHEN 2 THEN concat('<a class="PreviewTooltip" href="/p">', title, ' no. ', i, '</a>')
      ELSE concat('<h3 class="title"><em>New</em> <a href="/h"><script>var a = "no title";</script>', title, ' no. ', i, '</a></h3>') END,
      '</div></p><div class="meta"><a href="/u">a member of this forum here</a></div>')"""
    rows = ingest.thread_titles(_forum_pages(spark, sf_dir, 50, item), ingest.MODERN_FORUM, "sailingforums")
    return rows.select("page_id", "text", "source")


@query(f"""WITH c AS ({S.CORPUS}) SELECT source, count(*) AS n FROM c
 WHERE source IN ('sailingforums', 'huggingface_set_0', 'kaggle_set_12') GROUP BY source""")
def selected_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the sources on an allow-list of grouped labels."""
    wanted = ["Forums / SailingForums", "HuggingFace / Huggingface_Set 0", "kaggle-set 12 "]
    rows = ingest.selected_sources(corpus(spark, sf_dir), wanted)
    return rows.groupBy("source").agg(F.count("*").alias("n"))


def _collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = corpus(spark, sf_dir).select("text", "source", F.col("doc_id").alias("place"))
    turns = spread(table(spark, sf_dir, "conversations"), "conv_id", "turn").select(
        "text", F.concat(F.lit("chat_"), "role").alias("source"), (F.col("conv_id") * 1000 + F.col("turn")).alias("place")
    )
    items = table(spark, sf_dir, "benchmark").select("text", F.lit("benchmark").alias("source"), F.col("item_id").alias("place"))
    usable = ingest.available({"documents": documents, "conversations": turns, "benchmark": items})
    return ingest.merge([ingest.stamp(rows, F.col("source")) for rows in usable.values()], ["place"])


_COLLECTED = f"""u AS (SELECT text, source, 0 AS priority, doc_id AS place FROM ({S.CORPUS})
   UNION ALL SELECT text, 'chat_' || role, 1, conv_id * 1000 + turn FROM conversations
   UNION ALL SELECT text, 'benchmark', 2, item_id FROM benchmark),
 merged AS (SELECT text, source FROM u QUALIFY row_number() OVER (
   PARTITION BY {S.collection_key('text')} ORDER BY priority, place, source, text) = 1),
 kept AS (SELECT md5(source || chr(1) || text) AS id, text, 'unlabeled' AS label, source FROM merged
   WHERE length(text) BETWEEN 20 AND 5000)"""


@query(f"WITH {_COLLECTED} SELECT id, md5(text) AS text_md5, label, source FROM kept")
def merged_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources in one corpus: union, first copy of every text, length filter, ids."""
    return _collected(spark, sf_dir).select("id", F.md5("text").alias("text_md5"), "label", "source")


@query(f"""WITH {_COLLECTED} SELECT CASE WHEN grouping(source) = 1 THEN '*' ELSE source END AS source,
 count(*) AS rows, round(sum(length(text)) / count(*), 1) AS avg_len FROM kept GROUP BY GROUPING SETS ((source), ())""")
def collection_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.collection_metrics(_collected(spark, sf_dir))


@query("""WITH h AS (SELECT url, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\\.', '') AS host FROM pages)
 SELECT url, host, host AS display_name FROM h""")
def feed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host and display name of every page address."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "url", url_host(url).alias("host"), feed_display_name(url).alias("display_name")
    )


@query()
def quality_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before/after metrics written as JSON and read back."""
    before = corpus(spark, sf_dir)
    path = stage_path(spark, "metrics")
    after = staged(quality.clean(before, ["doc_id"]), "clean")
    rows = staged(quality.metric_rows(quality.compare(before, after, ["doc_id"])), "comparison")
    sinks.write_metrics(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("""SELECT event_type, count(*) AS n, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS k_total, max(json_extract(props, '$.k')::BIGINT) AS k_max
 FROM events GROUP BY event_type""")
def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON strings parsed with a fixed schema."""
    rows = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k"))
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("k").alias("k_total"), F.max("k").alias("k_max")
    )
