"""Queries over text functions, row filters and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import patterns as P
from textloom.functions import source_names as N
from textloom.functions import text as T
from textloom.functions.numbers import to_double
from textloom.operators import dedup, prepare, quality, similar
from textloom.operators.frames import tags_union
from textloom.plans import sql as S
from textloom.plans.catalog import corpus, query, spread, table
from textloom.plans.session import staged
from textloom.plans.stages import annotated_table, queue


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


@query(f"""SELECT doc_id, md5({S.collapse('text')}) AS collapsed, md5({S.key('text')}) AS dedup_key,
 md5({S.collection_key('text')}) AS collection_key, length(text) AS chars, left(text, 150) AS head,
 {S.strip('text')} = '' AS blank FROM documents""")
def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White space, both dedup keys, length and prefix of every document."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(T.collapse_whitespace(text)).alias("collapsed"),
        F.md5(T.dedup_key(text)).alias("dedup_key"),
        F.md5(T.collection_key(text)).alias("collection_key"),
        F.length(text).cast("bigint").alias("chars"),
        F.substring(text, 1, 150).alias("head"),
        T.is_blank(text).alias("blank"),
    )


# Artifact words that occur in the given pages: the default ones do not.
_SEEN = ("attion", "onth", "style")


@query(f"""WITH t AS (SELECT page_id, {S.without_markup('html', _SEEN)} AS text FROM pages)
 SELECT page_id, md5(text) AS text_md5, length(text) AS chars FROM t""")
def markup_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without tags, class/style attributes and artifact words."""
    text = T.remove_markup(F.col("html"), _SEEN)
    return _pages(spark, sf_dir).select("page_id", F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("chars"))


@query(f"""SELECT page_id, {S.matches('html', S.MARKUP)} AS markup, {S.matches('html', S.artifact(_SEEN))} AS artifact,
 {S.matches('html', P.SOURCE_MARKUP)} AS source_markup, len({S.found('html', P.ENTITY)}) AS entities FROM pages
 UNION ALL SELECT -1 - doc_id, {S.matches('text', S.MARKUP)}, {S.matches('text', S.artifact(_SEEN))},
 {S.matches('text', P.SOURCE_MARKUP)}, len({S.found('text', P.ENTITY)}) FROM documents""")
def markup_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two markup tests, the artifact test and the entity count on pages and documents."""
    pages = _pages(spark, sf_dir).select("page_id", F.col("html").alias("text"))
    documents = table(spark, sf_dir, "documents").select((-1 - F.col("doc_id")).alias("page_id"), "text")
    text = F.col("text")
    return pages.unionByName(documents).select(
        "page_id",
        T.has_markup(text).alias("markup"),
        T.has_artifact(text, _SEEN).alias("artifact"),
        T.has_source_markup(text).alias("source_markup"),
        T.entity_count(text).alias("entities"),
    )


_BASIC = "replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
# The pages hold four kinds of entity.
_FULL = "replace(replace(replace(replace(html, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&')"


@query(f"SELECT page_id, md5({_FULL}) AS decoded_md5, length({_FULL}) AS chars FROM pages")
def entities_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full entity decoding."""
    text = T.decode_entities(F.col("html"))
    rows = _pages(spark, sf_dir).select("page_id", text.alias("text"))
    return rows.select("page_id", F.md5("text").alias("decoded_md5"), F.length("text").cast("bigint").alias("chars"))


@query(f"SELECT page_id, md5({_BASIC}) AS decoded_md5 FROM pages")
def basic_entities_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", F.md5(T.decode_basic_entities(F.col("html"))).alias("decoded_md5"))


@query(f"""WITH t AS (SELECT doc_id, {S.found('lower(text)', P.CORPUS_TOKEN)} AS c, {S.found('lower(text)', P.MODEL_TOKEN)} AS m FROM documents)
 SELECT doc_id, len(c) AS corpus_tokens, md5(array_to_string(c, ' ')) AS corpus_md5, len(m) AS model_tokens,
 md5(array_to_string(m, ' ')) AS model_md5 FROM t""")
def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both analysers on every document."""
    rows = spread(table(spark, sf_dir, "documents"), "doc_id")
    tokens = rows.select("doc_id", T.corpus_tokens(F.col("text")).alias("c"), T.model_tokens(F.col("text")).alias("m"))
    return tokens.select(
        "doc_id",
        F.size("c").cast("bigint").alias("corpus_tokens"),
        F.md5(F.array_join("c", " ")).alias("corpus_md5"),
        F.size("m").cast("bigint").alias("model_tokens"),
        F.md5(F.array_join("m", " ")).alias("model_md5"),
    )


def _by_prefix(column: int) -> str:
    cases = " ".join(f"WHEN starts_with(source, '{family[0]}') THEN {S.text(family[column])}" for family in N.SOURCE_FAMILIES)
    other = (N.FORUM_LICENSE, N.UNKNOWN_LICENSE)
    return f"CASE {cases} WHEN contains(source, 'forum') THEN {S.text(other[0][column - 2])} ELSE {S.text(other[1][column - 2])} END"


_DISPLAY = (
    "CASE "
    + " ".join(
        f"WHEN starts_with(source, '{prefix}') THEN {S.text(title)} || "
        + (f"substr(source, {len(prefix) + 1})" if prefix == "rss_" else f"replace(substr(source, {len(prefix) + 1}), '_', ' ')")
        for prefix, title, _, _ in N.SOURCE_FAMILIES
    )
    + " WHEN contains(lower(source), 'forum') THEN 'Forum / ' || source ELSE replace(source, '_', ' ') END"
)


@query(f"""WITH c AS ({S.CORPUS}) SELECT source, {_DISPLAY} AS display_name, count(*) AS n, {_by_prefix(2)} AS license, {_by_prefix(3)} AS status,
 CASE WHEN starts_with(source, 'huggingface_') THEN 'low' WHEN starts_with(source, 'stackexchange_')
   OR starts_with(source, 'rss_') OR source = 'sailingforums' THEN 'high' ELSE 'medium' END AS fit,
 {S.THEMATIC} AS thematic, trim(regexp_replace(replace(lower(source), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS normalized,
 trim(regexp_replace(lower(source), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM c GROUP BY source""")
def source_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that is derived from a source's name."""
    source = F.col("source")
    return (
        corpus(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))
        .select(
            "source", "n",
            N.display_name(source).alias("display_name"),
            N.license_type(source).alias("license"),
            N.license_status(source).alias("status"),
            N.topical_fit(source).alias("fit"),
            N.is_thematic(source).alias("thematic"),
            N.normalize_source(source).alias("normalized"),
            N.tag_slug(source).alias("slug"),
        )
    )


@query(f"""SELECT regexp_replace(lower({S.strip('p_type')}), {S.text(P.SPACES)}, '_', 'g') AS class_name, count(*) AS n FROM part GROUP BY 1""")
def class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class names from free labels."""
    name = T.safe_class_name(F.col("p_type")).alias("class_name")
    return table(spark, sf_dir, "part").groupBy(name).agg(F.count("*").alias("n"))


@query("""WITH v AS (SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN 'n/a' WHEN n_chars % 3 = 1 THEN NULL ELSE '0.' || n_chars END AS value FROM documents)
 SELECT doc_id, coalesce(try_cast(value AS DOUBLE), 0.0) AS number FROM v""")
def numbers_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric coercion of strings; anything else counts as zero."""
    kind = F.col("n_chars") % 3
    value = F.when(kind == 0, "n/a").when(kind == 2, F.concat(F.lit("0."), F.col("n_chars").cast("string")))
    return table(spark, sf_dir, "documents").select("doc_id", to_double(value).alias("number"))


_GAPS = f"""gaps AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS text,
 CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS source, n_chars FROM ({S.CORPUS}) JOIN (SELECT doc_id, n_chars FROM documents) USING (doc_id))"""


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with nulls in text and source, and without a label column."""
    rows = corpus(spark, sf_dir)
    return rows.select(
        "doc_id",
        F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("source"),
    )


@query(f"WITH {_GAPS} SELECT doc_id, md5(coalesce(text, '')) AS text_md5, source, 'unlabeled' AS label FROM gaps")
def quality_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_quality(_gaps(spark, sf_dir)).withColumn("text_md5", F.md5("text")).drop("text")


@query(f"""WITH {_GAPS} SELECT row_number() OVER (ORDER BY doc_id)::VARCHAR AS id, doc_id, md5(coalesce(text, '')) AS text_md5,
 coalesce(source, 'unknown') AS source FROM gaps""")
def annotation_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without ids are numbered by their position."""
    rows = prepare.prepare_annotation(_gaps(spark, sf_dir), ["doc_id"])
    return rows.select("id", "doc_id", F.md5("text").alias("text_md5"), "source")


@query(f"""WITH {_GAPS} SELECT doc_id::VARCHAR AS id, 'other_or_offtopic' AS label, coalesce(source, 'unknown') AS source,
 coalesce(try_cast(CASE WHEN doc_id % 2 = 0 THEN '0.5' ELSE 'high' END AS DOUBLE), 0.0) AS confidence, 'fallback' AS label_source FROM gaps""")
def labeled_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing annotation columns get their defaults, odd confidences become zero."""
    rows = _gaps(spark, sf_dir).withColumns(
        {"id": F.col("doc_id"), "confidence": F.when(F.col("doc_id") % 2 == 0, "0.5").otherwise("high")}
    )
    return prepare.prepare_labeled(rows).select("id", "label", "source", "confidence", "label_source")


@query(f"""WITH {_GAPS}, p AS (SELECT doc_id, coalesce(text, '') AS text, source FROM gaps)
 SELECT 'drop' AS strategy, doc_id, source FROM p WHERE source IS NOT NULL
 UNION ALL SELECT 'fill', doc_id, coalesce(source, '') FROM p UNION ALL SELECT 'keep', doc_id, source FROM p""")
def missing_handled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare.prepare_quality(_gaps(spark, sf_dir))
    results = [(name, prepare.handle_missing(rows, name).select("doc_id", "source")) for name in ("drop", "fill", "keep")]
    return tags_union(results, "strategy")


@query(f"""SELECT 'short' AS step, doc_id, md5(text) AS text_md5 FROM documents WHERE length(text) >= 50
 UNION ALL SELECT 'truncate', doc_id, md5(left(text, 1000)) FROM documents
 UNION ALL SELECT 'long', doc_id, md5(text) FROM documents WHERE length(text) <= 1000
 UNION ALL SELECT 'finish', doc_id, md5({S.collapse('text')}) FROM documents WHERE {S.collapse('text')} <> ''
 UNION ALL SELECT 'collect', doc_id, md5(text) FROM documents WHERE length(text) BETWEEN 20 AND 5000""")
def length_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short, long and blank text rules."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    steps = [
        ("short", prepare.handle_short(rows)),
        ("truncate", prepare.handle_long(rows, "truncate")),
        ("long", prepare.handle_long(rows, "filter")),
        ("finish", prepare.finish_text(rows)),
        ("collect", prepare.filter_collected(rows)),
    ]
    return tags_union(steps, "step").select("step", "doc_id", F.md5("text").alias("text_md5"))


@query(f"""WITH {S.ANNOTATED}, rare AS (SELECT id, CASE WHEN id = '3' THEN 'single' WHEN id = '4' THEN 'unlabeled' ELSE label END AS label, text FROM annotated)
 SELECT id, label FROM rare WHERE label NOT IN ('unlabeled', 'other_or_offtopic', 'single') AND {S.strip('text')} <> ''""")
def trainable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to train on: labelled, not for review, not blank, no class of a single row."""
    label = F.when(F.col("id") == "3", "single").when(F.col("id") == "4", "unlabeled").otherwise(F.col("label"))
    rows = prepare.trainable_rows(annotated_table(spark, sf_dir).withColumn("label", label))
    return prepare.drop_rare_classes(rows).select("id", "label")


@query(f"""WITH {S.ANNOTATED}, blanked AS (SELECT id, text, CASE WHEN doc_id % 4 = 0 THEN '  ' WHEN doc_id % 4 = 1 THEN NULL ELSE label END AS label FROM annotated)
 SELECT 'training' AS step, id, label FROM blanked WHERE {S.strip("coalesce(label, '')")} <> '' AND {S.strip('text')} <> ''
 UNION ALL SELECT 'from_disk', id, label FROM annotated WHERE label NOT IN ('unlabeled', 'other_or_offtopic')""")
def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row rules of active learning."""
    rows = annotated_table(spark, sf_dir)
    kind = F.col("doc_id") % 4
    blanked = rows.withColumn("label", F.when(kind == 0, "  ").when(kind == 2, F.col("label")).when(kind == 3, F.col("label")))
    steps = [
        ("training", prepare.prepare_training(blanked).select("id", "label")),
        ("from_disk", prepare.labelled_only(rows).select("id", "label")),
    ]
    return tags_union(steps, "step")


@query(f"""WITH {S.QUEUE} SELECT id, CASE WHEN trim(corrected_label) <> '' THEN trim(corrected_label) ELSE label END AS label FROM queue
 WHERE {S.strip('text')} <> ''""")
def pool_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pool of active learning: a correction wins over the automatic label."""
    return prepare.prepare_pool(queue(spark, sf_dir)).select("id", "label")


@query("SELECT doc_id, row_number() OVER (ORDER BY lang, doc_id) - 1 AS pos FROM documents")
def row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global positions without a single-task sort."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return dedup.with_position(rows, ["lang", "doc_id"]).select("doc_id", "pos")


@query(f"SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY {S.key('text')} ORDER BY doc_id) = 1")
def first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of every distinct text."""
    rows = spread(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "source", "text")
    return dedup.keep_first(rows, T.dedup_key(F.col("text")), ["doc_id"]).select("doc_id", "source")


_DISTINCT = f"""d AS (SELECT doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY {S.key('text')} ORDER BY doc_id) = 1),
 p AS (SELECT doc_id, length(text) AS len, row_number() OVER (ORDER BY doc_id) - 1 AS pos, {S.strip('text')} = '' AS blank FROM d)"""


@query(f"""WITH {_DISTINCT} SELECT a.pos AS pos_1, b.pos AS pos_2, a.len AS len_1, b.len AS len_2 FROM p a JOIN p b
 ON b.pos > a.pos AND b.pos <= a.pos + 49 WHERE NOT a.blank AND NOT b.blank
 AND 200.0 * least(a.len, b.len) / (a.len + b.len) >= 90.0""")
def fuzzy_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring pairs that the length bound leaves over."""
    rows = spread(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text")
    distinct = dedup.keep_first(rows, T.dedup_key(F.col("text")), ["doc_id"])
    return dedup.candidate_pairs(dedup.with_position(distinct, ["doc_id"]))


@query()
def similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an earlier one that is 90 % similar, wherever that stands."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = similar.similar_rows(rows, pos_col="doc_id")
    return found.select(F.col("pos").alias("doc_id"), F.col("twin").alias("twin_doc_id"), F.round("similarity", 2).alias("similarity"))


@query(f"SELECT doc_id, coalesce({S.key("split_part(text, chr(10), 1)")}, '') AS topic FROM documents")
def topic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines as normalised topics."""
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_topic(first).alias("topic"))


@query()
def near_duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate pairs of all documents."""
    return quality.find_fuzzy_duplicates(corpus(spark, sf_dir), ["doc_id"])


@query()
def near_duplicate_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five pairs."""
    return quality.find_fuzzy_duplicates(corpus(spark, sf_dir), ["doc_id"]).orderBy("pos_1", "pos_2").limit(5)


@query()
def cleaned_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cleaning steps with default settings."""
    return quality.clean(corpus(spark, sf_dir), ["doc_id"])


_MIXED = f"""mixed AS (SELECT doc_id AS place, text, source FROM ({S.CORPUS})
 UNION ALL SELECT 1000000000 + page_id, html, CASE WHEN page_id % 9 = 0 THEN NULL ELSE 'pages' END FROM pages)"""


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents followed by raw pages, some without a source."""
    pages = _pages(spark, sf_dir)
    return corpus(spark, sf_dir).select(F.col("doc_id").alias("place"), "text", "source").unionByName(
        pages.select(
            (F.col("page_id") + 1_000_000_000).alias("place"), F.col("html").alias("text"),
            F.when(F.col("page_id") % 9 != 0, "pages").alias("source"),
        )
    )


_DECODED = _FULL.replace("html", "text")


@query(f"""WITH {_MIXED}, decoded AS (SELECT place, {S.without_markup(_DECODED, _SEEN)} AS text, source FROM mixed WHERE source IS NOT NULL),
 firsts AS (SELECT * FROM decoded QUALIFY row_number() OVER (PARTITION BY {S.key('text')} ORDER BY place) = 1),
 cut AS (SELECT place, source, {S.collapse('left(text, 1000)')} AS text FROM firsts WHERE length(text) >= 50)
 SELECT place, source, 'unlabeled' AS label, md5(text) AS text_md5, length(text) AS chars FROM cut WHERE text <> ''""")
def cleaned_without_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and raw pages through every cleaning step but the near-duplicate one."""
    rows = quality.clean(_mixed(spark, sf_dir), ["place"], {"fuzzy_duplicates": "keep"}, words=_SEEN)
    return rows.select("place", "source", "label", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("chars"))


@query(f"""WITH {_MIXED}, k AS (SELECT *, {S.key('text')} AS key FROM mixed)
 SELECT count(*) AS total_rows, (SELECT count(*) FROM mixed WHERE source IS NULL) AS missing_count, 'source' AS missing_columns,
 count(nullif(key, '')) - count(DISTINCT nullif(key, '')) AS duplicates,
 {S.pct("count(nullif(key, '')) - count(DISTINCT nullif(key, ''))", 'count(*)')} AS duplicates_pct,
 count(*) FILTER (WHERE length(text) < 50) AS short_texts, {S.pct('count(*) FILTER (WHERE length(text) < 50)', 'count(*)')} AS short_pct,
 count(*) FILTER (WHERE length(text) > 1000) AS long_texts, {S.pct('count(*) FILTER (WHERE length(text) > 1000)', 'count(*)')} AS long_pct,
 count(*) FILTER (WHERE {S.matches('text', S.MARKUP)}) AS html_entities, {S.pct(f"count(*) FILTER (WHERE {S.matches('text', S.MARKUP)})", 'count(*)')} AS html_pct,
 (SELECT string_agg(left(text, 150), '|' ORDER BY place) FROM (SELECT * FROM mixed WHERE {S.matches('text', S.MARKUP)} ORDER BY place LIMIT 3)) AS html_examples,
 count(*) FILTER (WHERE {S.matches('text', S.artifact(_SEEN))}) AS html_artifacts,
 concat_ws(',', {', '.join(f"CASE WHEN bool_or(contains(lower(text), '{word}')) THEN '{word}' END" for word in sorted(_SEEN))}) AS patterns,
 count(*)::DOUBLE AS imbalance_ratio,
 CAST((count_if(source IS NULL) > 0)::INT + (count(nullif(key, '')) > count(DISTINCT nullif(key, '')))::INT + (count_if(length(text) < 50) > 0)::INT
  + (count_if(length(text) > 1000) > 0)::INT + (count(*) FILTER (WHERE {S.matches('text', S.MARKUP)}) > 0)::INT
  + (count(*) FILTER (WHERE {S.matches('text', S.artifact(_SEEN))}) > 0)::INT + (count(*) > 1)::INT AS BIGINT) AS issues_found FROM k""")
def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality report of documents and raw pages, near duplicates left out."""
    report = quality.detect_issues(_mixed(spark, sf_dir), ["place"], words=_SEEN, fuzzy=False)
    return report.withColumns(
        {
            "missing_columns": F.array_join("missing_columns", ","),
            "html_examples": F.array_join("html_examples", "|"),
            "patterns": F.array_join("patterns", ","),
        }
    ).drop("fuzzy_pairs", "fuzzy_threshold", "label_distribution")


@query()
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full quality report of the documents, near duplicates included."""
    return quality.detect_issues(corpus(spark, sf_dir), ["doc_id"])


@query(f"""WITH c AS ({S.CORPUS}), n AS (SELECT label, count(*) AS rows FROM c GROUP BY label)
 SELECT label, rows, round(max(rows) OVER () / min(rows) OVER (), 2) AS imbalance_ratio FROM n""")
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per label and the imbalance ratio."""
    counts = quality.label_distribution(corpus(spark, sf_dir))
    return counts.withColumn("imbalance_ratio", F.lit(quality.imbalance_ratio(counts).first()[0]))


@query()
def quality_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality before and after cleaning."""
    before = corpus(spark, sf_dir)
    return quality.compare(before, staged(quality.clean(before, ["doc_id"]), "clean"), ["doc_id"])
