"""Queries over automatic labels, review and agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import labelling, prepare, quality
from textloom.operators.frames import tags_union
from textloom.plans import sql as S
from textloom.plans.catalog import corpus, query, table
from textloom.plans.stages import annotated, annotated_table, queue

THRESHOLDS = [0.3, 0.5, 0.7, 0.9, 1.0]


@query(f"WITH {S.ANNOTATED} SELECT id, label, confidence, label_source FROM annotated")
def auto_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotated(spark, sf_dir).select("id", "label", "confidence", "label_source")


@query("""SELECT id, CASE WHEN vowels * 100 // greatest(chars, 1) >= 35 THEN 'navigation' ELSE 'safety' END AS label,
 vowels * 1000 // greatest(chars, 1) / 1000 AS confidence, 'zero_shot' AS label_source
 FROM (SELECT doc_id::VARCHAR AS id, length(text) AS chars, length(regexp_replace(text, '[^aeiou]', '', 'g')) AS vowels FROM documents)""")
def scorer_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels from a pluggable scorer, in batches of 16."""

    def share_of_vowels(texts: list[str], labels: list[str]) -> list[tuple[str, float]]:
        shares = [(sum(char in "aeiou" for char in text), max(len(text), 1)) for text in texts]
        return [(labels[0] if v * 100 // n >= 35 else labels[1], v * 1000 // n / 1000) for v, n in shares]

    rows = corpus(spark, sf_dir).select("id", "text", "source")
    return labelling.auto_label_with(rows, share_of_vowels).select("id", "label", "confidence", "label_source")


@query(f"""WITH {S.ANNOTATED} SELECT CASE WHEN confidence >= 0.7 THEN 'confident' ELSE 'review' END AS part, id, label, confidence FROM annotated""")
def confidence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    confident, review = labelling.split_by_confidence(annotated_table(spark, sf_dir))
    return tags_union([("confident", confident), ("review", review)], "part").select("part", "id", "label", "confidence")


_MAP = "(SELECT string_agg({0} || '=' || n, ' ' ORDER BY {0}) FROM (SELECT {0}, count(*) AS n FROM annotated GROUP BY 1))"


@query(f"""WITH {S.ANNOTATED} SELECT count(*) AS total_labeled, round(avg(confidence), 4) AS confidence_mean, round(stddev_pop(confidence), 4) AS confidence_std,
 count(*) FILTER (WHERE confidence < 0.7) AS low_confidence_count, {S.pct('count(*) FILTER (WHERE confidence < 0.7)', 'count(*)')} AS low_confidence_pct,
 count(*) FILTER (WHERE confidence >= 0.7) AS high_confidence_count, count(*) FILTER (WHERE label = 'other_or_offtopic') AS review_label_count,
 {_MAP.format('label')} AS label_distribution, {_MAP.format('label_source')} AS label_source_distribution FROM annotated""")
def annotation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation report; maps joined to strings."""
    report = labelling.annotation_quality(annotated(spark, sf_dir))

    def joined(name: str):
        entries = F.array_sort(F.map_entries(name))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), " ")

    return report.withColumns({name: joined(name) for name in ("label_distribution", "label_source_distribution")})


_PAIRS = f"""{S.QUEUE}, pairs AS (SELECT q.label AS a, q.corrected_label AS b FROM queue q JOIN annotated USING (id) WHERE q.corrected_label <> '')"""


@query(f"WITH {_PAIRS} SELECT a AS label, b AS corrected_label, count(*) AS rows FROM pairs GROUP BY ALL")
def agreement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automatic label against correction."""
    rows = annotated_table(spark, sf_dir)
    return labelling.agreement_counts(rows, queue(spark, sf_dir, rows))


@query(f"""WITH {_PAIRS}, n AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE a = b) AS agreed FROM pairs),
 e AS (SELECT sum(x.n::DOUBLE * y.n) AS chance FROM (SELECT a AS l, count(*) AS n FROM pairs GROUP BY 1) x JOIN (SELECT b AS l, count(*) AS n FROM pairs GROUP BY 1) y USING (l)),
 k AS (SELECT n, (agreed / n - chance / (n * n)) / (1 - chance / (n * n)) AS kappa FROM n, e)
 SELECT round(kappa, 3) AS cohens_kappa, n::BIGINT AS kappa_n_samples, CASE WHEN kappa > 0.8 THEN 'excellent (>0.8)' WHEN kappa > 0.6 THEN 'good (0.6-0.8)'
 WHEN kappa > 0.4 THEN 'moderate (0.4-0.6)' ELSE 'fair (<0.4)' END AS kappa_interpretation FROM k""")
def kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotated_table(spark, sf_dir)
    return labelling.kappa(rows, queue(spark, sf_dir, rows))


@query(f"""WITH {S.ANNOTATED}, t AS (SELECT unnest([{', '.join(f'{value}::DOUBLE' for value in THRESHOLDS)}]) AS threshold)
 SELECT threshold, count(*) FILTER (WHERE confidence < threshold) AS rows_below, {S.pct('count(*) FILTER (WHERE confidence < threshold)', 'count(*)')} AS pct_below
 FROM annotated, t GROUP BY threshold""")
def review_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review load at several thresholds."""
    return labelling.review_impact(annotated(spark, sf_dir), THRESHOLDS)


@query(f"WITH {S.ANNOTATED} SELECT least(floor(confidence * 30), 29)::BIGINT AS bin, count(*) AS rows FROM annotated GROUP BY 1")
def confidence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelling.confidence_histogram(annotated(spark, sf_dir))


@query(f"""WITH {S.QUEUE}, d AS (SELECT count(*) AS n, count(*) FILTER (WHERE trim(corrected_label) <> '') AS done FROM queue)
 SELECT n AS total, done AS reviewed, n - done AS remaining, {S.pct('done', 'n')} AS progress_pct FROM d""")
def review_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelling.review_progress(queue(spark, sf_dir))


@query(f"""WITH {S.QUEUE} SELECT id, label, source FROM queue WHERE label = 'fr' AND trim(corrected_label) = '' ORDER BY id LIMIT 10 OFFSET 10""")
def review_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of the open reviews of one class."""
    rows = labelling.browse_queue(queue(spark, sf_dir), label="fr")
    return prepare.page(rows, 2, ["id"]).select("id", "label", "source")


@query(f"""WITH {S.QUEUE} SELECT 'any' AS rule, id, corrected_label AS label FROM queue WHERE corrected_label <> ''
 UNION ALL SELECT 'stripped', id, corrected_label FROM queue WHERE trim(corrected_label) <> ''""")
def corrected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rules for what counts as corrected."""
    rows = queue(spark, sf_dir)
    results = [("any", labelling.corrected_rows(rows)), ("stripped", labelling.corrected_rows(rows, strip_first=True))]
    return tags_union(results, "rule").select("rule", "id", "label")


@query(f"""WITH {S.QUEUE} SELECT id, label, confidence, label_source FROM annotated WHERE confidence >= 0.7
 UNION ALL SELECT id, corrected_label, 1.0::DOUBLE, 'hitl' FROM queue WHERE corrected_label <> ''""")
def reviewed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confident rows with the corrections merged in."""
    rows = annotated_table(spark, sf_dir)
    confident = labelling.split_by_confidence(rows)[0].drop("truth", "doc_id")
    merged = labelling.merge_reviews(confident, queue(spark, sf_dir, rows))
    return merged.select("id", "label", "confidence", "label_source")


@query(f"""WITH {S.QUEUE}, fixed AS (SELECT id, corrected_label AS label FROM queue WHERE trim(corrected_label) <> '')
 SELECT 'append' AS mode, id, label FROM annotated UNION ALL SELECT 'append', id, label FROM fixed
 UNION ALL SELECT 'override', id, label FROM annotated WHERE id NOT IN (SELECT id FROM fixed) UNION ALL SELECT 'override', id, label FROM fixed""")
def retraining_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows plus corrections, the corrected originals kept or replaced."""
    rows = annotated_table(spark, sf_dir)
    reviews = queue(spark, sf_dir, rows)
    modes = [(mode, labelling.retraining_rows(rows, reviews, mode).select("id", "label")) for mode in ("append", "override")]
    return tags_union(modes, "mode")


_DECODED = "replace(replace(replace(replace(text, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&')"


@query(f"""WITH {S.QUEUE}, decoded AS (SELECT doc_id, {S.without_markup(_DECODED)} AS text FROM documents),
 firsts AS (SELECT text FROM decoded QUALIFY row_number() OVER (PARTITION BY {S.key('text')} ORDER BY doc_id) = 1),
 clean AS (SELECT text FROM firsts WHERE length(text) >= 50 AND {S.collapse('left(text, 1000)')} <> '')
 SELECT (SELECT count(*) FROM documents) AS total_rows, (SELECT count(*) FROM clean) AS clean_rows,
 (SELECT count(*) FROM annotated) AS annotated_rows, (SELECT count(*) FROM queue) AS review_queue_rows,
 (SELECT count(*) FROM queue WHERE trim(corrected_label) <> '') AS reviewed_rows,
 (SELECT count(*) FROM documents) - (SELECT count(*) FROM clean) AS rows_removed,
 (SELECT round(avg(confidence), 3) FROM annotated) AS confidence_mean""")
def progress_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts over all stages; of the cleaning steps only the near-duplicate one, beyond SQL for documents, keeps its rows."""
    raw = corpus(spark, sf_dir)
    rows = annotated_table(spark, sf_dir)
    return labelling.progress_report(raw, quality.clean(raw, ["doc_id"], {"fuzzy_duplicates": "keep"}), rows, queue(spark, sf_dir, rows))


@query("""SELECT doc_id, CASE WHEN quality IS NULL THEN '' WHEN quality = 1 THEN lang ELSE 'reject' END AS corrected_label
 FROM documents LEFT JOIN labels USING (doc_id)""")
def corrections_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions written back to the queue: good documents keep the suggested label, others are rejected."""
    queued = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("suggested_label"), F.lit("").alias("corrected_label")
    )
    label = F.when(F.col("quality") != 1, "reject").alias("label")
    decisions = table(spark, sf_dir, "labels").where("quality IS NOT NULL").select(F.col("doc_id").alias("id"), label)
    return labelling.apply_corrections(queued, decisions).select(F.col("id").alias("doc_id"), "corrected_label")
