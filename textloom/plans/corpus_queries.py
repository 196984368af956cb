"""Queries over the corpus reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import patterns as P
from textloom.functions import source_names as N
from textloom.functions.stopwords import SUMMARY, report_stopwords
from textloom.functions.text import collection_key
from textloom.operators import corpus as C
from textloom.operators import prepare
from textloom.operators.dedup import keep_first
from textloom.operators.frames import tags_union
from textloom.plans import flow
from textloom.plans import sql as S
from textloom.plans.catalog import corpus, query, spread, table

TOPIC = "sailing and yacht navigation"
STOPWORDS = report_stopwords(TOPIC)

_PER_SOURCE = f"""SELECT source, count(*) AS rows, round(sum(length(text)) / count(*), 2) AS avg_len,
 min(length(text)) AS min_len, max(length(text)) AS max_len,
 {S.pct(f"count(*) FILTER (WHERE {S.strip('text')} = '')", 'count(*)')} AS empty_pct,
 {S.pct('count(*) FILTER (WHERE length(text) < 50)', 'count(*)')} AS short_pct,
 {S.pct('count(*) FILTER (WHERE length(text) > 1000)', 'count(*)')} AS long_pct,
 {S.pct(f"count(*) FILTER (WHERE {S.matches('text', P.SOURCE_MARKUP)})", 'count(*)')} AS html_pct,
 {S.pct(f"count(*) - count(DISTINCT {S.collection_key('text')})", 'count(*)')} AS duplicates_pct"""


@query(f"""WITH c AS ({S.CORPUS}), k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY {S.collection_key('text')} ORDER BY doc_id) = 1)
 {_PER_SOURCE} FROM k WHERE length(text) BETWEEN 20 AND 5000 GROUP BY source""")
def corpus_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the collected corpus, first copies of usable length, and its quality by source."""
    kept = keep_first(corpus(spark, sf_dir).select("doc_id", "text", "source"), collection_key(F.col("text")), ["doc_id"])
    return C.source_quality(prepare.filter_collected(kept))


_PAGES = """SELECT page_id, html AS text, split_part(split_part(url, '://', 2), '/', 1) AS source FROM pages"""


@query(f"""WITH c AS (SELECT text, source FROM ({S.CORPUS}) UNION ALL SELECT text, 'rss_' || source FROM ({_PAGES})) {_PER_SOURCE} FROM c GROUP BY source""")
def source_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality by source of documents and raw pages, copies included."""
    return C.source_quality(_with_pages(spark, sf_dir))


def _with_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages"), "page_id")
    host = F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))
    rows = pages.select(F.col("html").alias("text"), F.concat(F.lit("rss_"), host).alias("source"))
    return corpus(spark, sf_dir).select("text", "source").unionByName(rows)


@query(f"""WITH c AS ({S.CORPUS}) SELECT source, count(*) AS rows, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS share_pct FROM c GROUP BY source""")
def source_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.source_distribution(corpus(spark, sf_dir))


@query()
def corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table of the corpus report."""
    tables = flow.corpus_report(corpus(spark, sf_dir), TOPIC)
    counts = [(name, frame.agg(F.count("*").alias("rows"))) for name, frame in tables.items()]
    return tags_union(counts, "name")


@query(f"""WITH c AS ({S.CORPUS}), t AS (SELECT count(*) FILTER (WHERE {S.THEMATIC}) AS a, count(*) AS n FROM c)
 SELECT a AS thematic_rows, n - a AS off_topic_rows, {S.pct('a', 'n')} AS thematic_pct, {S.pct('n - a', 'n')} AS off_topic_pct FROM t""")
def thematic_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.thematic_split(corpus(spark, sf_dir))


@query("""SELECT count(*) AS rows, round(sum(length(text)) / count(*), 4) AS mean_len, quantile_cont(length(text), 0.5) AS median_len,
 round(quantile_cont(length(text), 0.95), 4) AS p95_len, min(length(text)) AS min_len, max(length(text)) AS max_len FROM documents""")
def length_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.length_statistics(corpus(spark, sf_dir))


@query("""WITH l AS (SELECT length(text) AS len, min(length(text)) OVER () AS lo, max(length(text)) OVER () AS hi FROM documents)
 SELECT least((len - lo) * 50 // (hi - lo), 49)::BIGINT AS bin, count(*) AS rows FROM l GROUP BY 1""")
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.length_histogram(corpus(spark, sf_dir))


_BOX = f"""l AS (SELECT source, doc_id, length(text) AS len FROM ({S.CORPUS})),
 q AS (SELECT source, quantile_cont(len, 0.25) AS q1, quantile_cont(len, 0.5) AS median, quantile_cont(len, 0.75) AS q3 FROM l GROUP BY source),
 o AS (SELECT *, len < q1 - 1.5 * (q3 - q1) OR len > q3 + 1.5 * (q3 - q1) AS outside FROM l JOIN q USING (source))"""


@query(f"""WITH {_BOX} SELECT source, q1, median, q3, min(len) FILTER (WHERE NOT outside) AS lower_fence, max(len) FILTER (WHERE NOT outside) AS upper_fence,
 count(*) FILTER (WHERE outside) AS outliers FROM o GROUP BY source, q1, median, q3""")
def length_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.length_boxes(corpus(spark, sf_dir))


@query(f"WITH {_BOX} SELECT doc_id, source, len AS text_len FROM o WHERE outside")
def length_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows beyond the fences of their source."""
    rows = C.prepare_corpus(corpus(spark, sf_dir))
    return C.length_outliers(rows).select("doc_id", "source", "text_len")


_TOKENS = f"""SELECT source, unnest({S.found('lower(text)', P.CORPUS_TOKEN)}) AS token FROM ({S.CORPUS})"""


@query(f"""SELECT token, count(*) AS n FROM ({_TOKENS}) WHERE token NOT IN ({S.words(STOPWORDS)}) GROUP BY token""")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of every token but stopwords."""
    return C.token_counts(corpus(spark, sf_dir), STOPWORDS)


@query(f"""SELECT token, count(*) AS n FROM ({_TOKENS}) WHERE token NOT IN ({S.words(STOPWORDS)}) AND {S.THEMATIC} GROUP BY token ORDER BY n DESC, token LIMIT 5""")
def thematic_top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent tokens of thematic sources."""
    return C.top_tokens(corpus(spark, sf_dir).where(N.is_thematic(F.col("source"))), STOPWORDS)


@query(f"""WITH n AS (SELECT source, token, count(*) AS n FROM ({_TOKENS}) WHERE token NOT IN ({S.words(STOPWORDS)}) GROUP BY ALL)
 SELECT source, token, n, row_number() OVER (PARTITION BY source ORDER BY n DESC, token)::INT AS rank FROM n QUALIFY rank <= 10""")
def top_tokens_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.top_tokens_by_source(corpus(spark, sf_dir), STOPWORDS)


@query(f"""WITH c AS (SELECT text, source FROM ({S.CORPUS}) UNION ALL SELECT text, 'rss_' || source FROM ({_PAGES})),
 t AS (SELECT source, unnest({S.found('lower(text)', P.CORPUS_TOKEN)}) AS token FROM c),
 n AS (SELECT source, token, count(*) AS n FROM t WHERE token NOT IN ({S.words(SUMMARY)}) GROUP BY ALL),
 g AS (SELECT token, sum(n) AS n FROM n GROUP BY token ORDER BY n DESC, token LIMIT 15),
 s AS (SELECT source, string_agg(token, ' ' ORDER BY n DESC, token) AS w FROM (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, token) <= 8) GROUP BY source),
 d AS (SELECT source, count(*) AS rows FROM c GROUP BY source)
 SELECT count(*) AS total_rows, round(sum(length(text)) / count(*), 2) AS avg_text_len, min(length(text)) AS min_text_len, max(length(text)) AS max_text_len,
 {S.pct('count(*) FILTER (WHERE length(text) < 50)', 'count(*)')} AS pct_short_texts, {S.pct('count(*) FILTER (WHERE length(text) > 500)', 'count(*)')} AS pct_long_texts,
 sum(len({S.found('text', P.ENTITY)}))::BIGINT AS html_entity_count,
 (SELECT string_agg(source || '=' || rows, ' ' ORDER BY source) FROM d) AS source_distribution,
 (SELECT string_agg(token, ' ' ORDER BY n DESC, token) FROM g) AS top_keywords_global,
 (SELECT string_agg(source || '=' || w, '|' ORDER BY source) FROM s) AS top_keywords_by_source FROM c""")
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of documents and raw pages; maps and lists joined to strings."""
    summary = C.dataset_summary(_with_pages(spark, sf_dir))

    def joined(name: str, between: str, value) -> F.Column:
        entries = F.array_sort(F.map_entries(name))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), value(e["value"]))), between)

    return summary.withColumns(
        {
            "source_distribution": joined("source_distribution", " ", lambda v: v.cast("string")),
            "top_keywords_global": F.array_join("top_keywords_global", " "),
            "top_keywords_by_source": joined("top_keywords_by_source", "|", lambda v: F.array_join(v, " ")),
        }
    )


_QUALITY = f"WITH c AS (SELECT text, source FROM ({S.CORPUS}) UNION ALL SELECT text, 'rss_' || source FROM ({_PAGES})), q AS ({_PER_SOURCE} FROM c GROUP BY source)"


@query(f"""{_QUALITY}, u AS (SELECT 'HTML artifacts' AS issue, 0 AS place, source, rows, html_pct AS value FROM q
 UNION ALL SELECT 'short texts', 1, source, rows, short_pct FROM q UNION ALL SELECT 'long texts', 2, source, rows, long_pct FROM q
 UNION ALL SELECT 'duplicates', 3, source, rows, duplicates_pct FROM q)
 SELECT issue, source, value FROM u WHERE value > 0 ORDER BY value DESC, rows DESC, source, place LIMIT 3""")
def issue_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest quality issues."""
    return C.issue_ranking(C.source_quality(_with_pages(spark, sf_dir)))


def _share(prefix: str) -> str:
    return S.pct(f"coalesce(sum(rows) FILTER (WHERE starts_with(source, '{prefix}')), 0)", "sum(rows)", 1)


@query(f"""{_QUALITY} SELECT sum(rows)::BIGINT AS total_rows, count(*) AS sources, {_share('huggingface_')} AS huggingface_pct,
 {_share('topic_bootstrap_')} AS bootstrap_pct, {_share('topic_bootstrap_')} >= 70.0 AS mostly_bootstrap,
 (SELECT source FROM q ORDER BY rows DESC, source LIMIT 1) AS top_source, {S.pct('max(rows)', 'sum(rows)', 1)} AS top_source_pct,
 (SELECT source FROM q ORDER BY avg_len DESC, source LIMIT 1) AS longest_source, max(max_len) AS max_len,
 coalesce(max(html_pct) FILTER (WHERE starts_with(source, 'rss_')), 0.0) AS rss_html_pct FROM q""")
def corpus_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.insights(C.source_quality(_with_pages(spark, sf_dir)))


@query(f"""WITH c AS ({S.CORPUS}), q AS (SELECT source, count(*) AS rows FROM c GROUP BY source)
 SELECT (SELECT source FROM q ORDER BY rows DESC, source LIMIT 1) AS dominant_source, {S.pct('max(rows)', 'sum(rows)', 1)} AS dominant_pct, count(*) AS sources,
 {', '.join(f"{_share(family[0])} AS {family[0]}pct" for family in N.SOURCE_FAMILIES)} FROM q""")
def source_hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.source_hypotheses(corpus(spark, sf_dir))
