"""Queries over features, training, evaluation and active learning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import patterns as P
from textloom.operators import active, classifier, labelling, metrics, split, tfidf
from textloom.operators.frames import side_by_side, tags_union
from textloom.plans import flow
from textloom.plans import sql as S
from textloom.plans.catalog import KEYWORDS, corpus, query, spread, table
from textloom.plans.session import small_side, stage_path, staged
from textloom.plans.stages import annotated_table, queue
from textloom.sources import ingest


def _tfidf_sql(bigrams: bool, sublinear: bool, limit: int) -> str:
    tokens = S.found("lower(text)", P.MODEL_TOKEN)
    grams = (
        "list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))" if bigrams else "t"
    )
    damped = "1 + ln(tf)" if sublinear else "tf"
    return f"""grams AS (SELECT doc_id, unnest({grams}) AS term FROM (SELECT doc_id, {tokens} AS t FROM documents)),
 tf AS (SELECT doc_id, term, count(*)::DOUBLE AS tf FROM grams GROUP BY ALL),
 vocabulary AS (SELECT term, sum(tf) AS n, count(*) AS docs FROM tf GROUP BY term ORDER BY n DESC, term LIMIT {limit}),
 raw AS (SELECT doc_id, term, ({damped}) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + docs)) + 1) AS w FROM tf JOIN vocabulary USING (term)),
 weights AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


@query(f"""WITH {_tfidf_sql(True, True, 10000)} SELECT term, n::BIGINT AS n, docs FROM vocabulary""")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and word pairs of the classifier with their counts."""
    terms = tfidf.vocabulary(spread(table(spark, sf_dir, "documents"), "doc_id"), tfidf.MODEL_TFIDF)
    return terms.where("term IS NOT NULL")


@query(f"""WITH {_tfidf_sql(True, True, 10000)} SELECT doc_id, term, round(weight, 8) AS weight FROM weights""")
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the classifier: words and word pairs, damped counts."""
    rows = spread(table(spark, sf_dir, "documents"), "doc_id")
    weights = tfidf.tfidf_weights(rows, tfidf.fit_tfidf(rows, tfidf.MODEL_TFIDF), "doc_id")
    return weights.withColumn("weight", F.round("weight", 8))


@query(f"""WITH {_tfidf_sql(False, False, 5000)} SELECT doc_id, term, round(weight, 8) AS weight FROM weights""")
def tfidf_weights_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the active-learning model: words, raw counts."""
    rows = spread(table(spark, sf_dir, "documents"), "doc_id")
    weights = tfidf.tfidf_weights(rows, tfidf.fit_tfidf(rows, tfidf.QUERY_TFIDF), "doc_id")
    return weights.withColumn("weight", F.round("weight", 8))


@query(f"""WITH {_tfidf_sql(False, False, 5000)}, labelled AS (SELECT w.*, lang FROM weights w JOIN documents USING (doc_id)),
 size AS (SELECT lang, count(*) AS docs FROM documents GROUP BY lang),
 mean AS (SELECT lang, term, sum(weight) / any_value(size.docs) AS m FROM labelled JOIN size USING (lang) GROUP BY ALL),
 mid AS (SELECT term, sum(weight) / (SELECT count(*) FROM documents) AS m FROM weights GROUP BY term),
 c AS (SELECT doc_id, lang AS label, term, round(weight * round(mean.m - mid.m, 9), 6) AS weight FROM labelled JOIN mean USING (lang, term) JOIN mid USING (term)
  WHERE round(weight * round(mean.m - mid.m, 9), 6) > 0)
 SELECT doc_id, label, weight, term, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term)::INT AS rank FROM c QUALIFY rank <= 5""")
def centroid_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that speak most for each document's language, by the distance of class centroids."""
    rows = spread(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text", "lang")
    model = tfidf.fit_tfidf(rows, tfidf.QUERY_TFIDF)
    weights = staged(tfidf.tfidf_weights(rows, model, "doc_id").join(rows.select("doc_id", "lang"), "doc_id"), "weights")
    sizes = {row[0]: row[1] for row in rows.groupBy("lang").count().collect()}
    labels = sorted(sizes)
    # One row per vocabulary term.
    means = weights.groupBy("term").agg(
        *[(F.sum(F.when(F.col("lang") == name, F.col("weight")).otherwise(0.0)) / sizes[name]).alias(name) for name in labels],
        (F.sum("weight") / sum(sizes.values())).alias("_mid"),
    )
    coefficients = {row["term"]: [round(row[name] - row["_mid"], 9) for name in labels] for row in means.collect()}
    matrix = np.array([coefficients.get(term, [0.0] * len(labels)) for term in model.terms]).T
    vectors = tfidf.transform_tfidf(rows, model).select("doc_id", F.col("lang").alias("label"), "features")
    return classifier.top_contributions(vectors, model, labels, matrix, "doc_id", 5)


_SPLIT = """counts AS (SELECT lang AS label, count(*) AS n, floor(round(0.2 * count(*), 9))::BIGINT AS q, 0.2 * count(*) - floor(round(0.2 * count(*), 9)) AS f FROM documents GROUP BY lang),
 quotas AS (SELECT label, q + (row_number() OVER (ORDER BY round(f, 9) DESC, label) <= (SELECT ceil(round(0.2 * sum(n), 9)) - sum(q) FROM counts))::INT AS quota FROM counts),
 ranked AS (SELECT doc_id, lang AS label, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '42'), doc_id) AS rn FROM documents)"""


@query(f"WITH {_SPLIT} SELECT doc_id, label, rn <= quota AS is_test FROM ranked JOIN quotas USING (label)")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """80/20 split per language."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    return split.with_test_flag(rows, id_col="doc_id")


@query("""SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || '42'), doc_id) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM documents""")
def plain_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """80/20 split without regard to the label."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    return split.with_test_flag(rows, id_col="doc_id", stratify=False).select("doc_id", "is_test")


@query("SELECT doc_id, source FROM documents ORDER BY md5(doc_id || '42'), doc_id LIMIT 20")
def random_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reproducible random rows."""
    return split.random_rows(table(spark, sf_dir, "documents").select("doc_id", "source"), 20, "doc_id")


_CHANCES = f"""{S.HITS}, chances AS (SELECT doc_id, [{', '.join(f'(hits_{name} + 1) / (total + {len(KEYWORDS)})' for name in KEYWORDS)}] AS p FROM scored),
 uncertain AS (SELECT doc_id, round(-({' + '.join(f'p[{i}] * ln(p[{i}] + 1e-10)' for i in range(1, len(KEYWORDS) + 1))}), 12) AS entropy,
  round(list_reverse_sort(p)[1] - list_reverse_sort(p)[2], 12) AS margin FROM chances)"""


def _chances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class probabilities from smoothed keyword hits."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(f"{P.WORD}+"), F.lit(0))
    hits = F.array(*[labelling.keyword_hits(F.col("w"), listed) for listed in KEYWORDS.values()])
    rows = corpus(spark, sf_dir).select("doc_id", words.alias("w")).select("doc_id", hits.alias("h"))
    total = F.aggregate("h", F.lit(0), lambda left, right: left + right) + len(KEYWORDS)
    return rows.select("doc_id", F.transform("h", lambda n: (n + 1) / total).alias("probability"))


@query(f"""WITH {_CHANCES} (SELECT 'entropy' AS strategy, doc_id FROM uncertain ORDER BY entropy DESC, doc_id LIMIT 20)
 UNION ALL (SELECT 'margin', doc_id FROM uncertain ORDER BY margin, doc_id LIMIT 20)
 UNION ALL (SELECT 'random', doc_id FROM uncertain ORDER BY md5(doc_id || '42'), doc_id LIMIT 20)""")
def uncertain_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows to label next under each strategy."""
    rows = _chances(spark, sf_dir)
    chosen = [(name, active.select_uncertain(rows, name, 20, "doc_id").select("doc_id")) for name in active.STRATEGIES]
    return tags_union(chosen, "strategy")


@query("""WITH f AS (SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) = 1)
 SELECT doc_id, lang AS label FROM f UNION ALL (SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM f)
 ORDER BY md5(doc_id || '42'), doc_id LIMIT (SELECT 50 - count(*) FROM f))""")
def initial_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed of active learning: first row per class, then random rows."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    return active.initial_sample(rows, 50, "doc_id")


@query("""WITH q AS (SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || '42'), doc_id LIMIT 20),
 f AS (SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) = 1)
 SELECT 'labelled' AS part, doc_id FROM (SELECT doc_id FROM f UNION ALL SELECT doc_id FROM q) UNION ALL
 SELECT 'pool', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM q)""")
def queried_rows_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step of the cycle: queried rows join the labelled ones and leave the pool."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    chosen = active.query(None, rows, "random", 20, "doc_id")
    labelled = active.initial_sample(rows, 1, "doc_id").unionByName(chosen)
    left = rows.join(small_side(chosen.select("doc_id")), "doc_id", "left_anti")
    return tags_union([("labelled", labelled.select("doc_id")), ("pool", left.select("doc_id"))], "part")


_CONFUSION = f"""{S.ANNOTATED}, counts AS (SELECT truth AS label, label AS prediction, count(*) AS rows FROM annotated GROUP BY ALL),
 sides AS (SELECT l AS label, coalesce(sum(h), 0)::BIGINT AS hits, sum(s)::BIGINT AS support, sum(p)::BIGINT AS predicted FROM (
  SELECT label AS l, CASE WHEN label = prediction THEN rows END AS h, rows AS s, 0 AS p FROM counts
  UNION ALL SELECT prediction, NULL, 0, rows FROM counts) GROUP BY l),
 f AS (SELECT *, coalesce(2.0 * hits / nullif(support + predicted, 0), 0.0)::DOUBLE AS f1 FROM sides)"""


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(annotated_table(spark, sf_dir), "truth", "label")


@query(f"""WITH {_CONFUSION} SELECT label, round(coalesce(hits / nullif(predicted, 0), 0.0), 4) AS precision, round(coalesce(hits / nullif(support, 0), 0.0), 4) AS recall,
 round(f1, 4) AS f1, support FROM f""")
def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 of the automatic labels against the language."""
    return metrics.class_scores(_confusion(spark, sf_dir))


@query(f"""WITH {_CONFUSION} SELECT round((SELECT sum(rows) FROM counts WHERE label = prediction) / (SELECT sum(rows) FROM counts), 4) AS accuracy,
 round(avg(f1), 4) AS f1_macro, round(sum(f1 * support) / sum(support), 4) AS f1_weighted, (SELECT sum(rows) FROM counts)::BIGINT AS n_test FROM f""")
def overall_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.overall_scores(_confusion(spark, sf_dir))


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("id", "text", "label")


@query()
def classifier_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and evaluate the classifier on the languages of all documents."""
    return classifier.train(_training(spark, sf_dir)).metrics


@query()
def classifier_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the training part, store, load, predict every document."""
    path = stage_path(spark, "model")
    classifier.train(_training(spark, sf_dir)).model.save(spark, path)
    model = classifier.TextModel.load(spark, path)
    return model.predict(_training(spark, sf_dir)).select("id", "label", "prediction", "probability")


@query()
def classifier_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten terms behind every document's prediction."""
    rows = staged(_training(spark, sf_dir).withColumn(tfidf.WORDS, tfidf.words_of()), "training")
    return classifier.TextClassifier().fit(rows).explain(rows)


@query()
def reviewed_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automatic labels, review merged in, then training: the whole flow after cleaning."""
    rows = annotated_table(spark, sf_dir)
    confident = labelling.split_by_confidence(rows)[0].drop("truth", "doc_id")
    merged = labelling.merge_reviews(confident, queue(spark, sf_dir, rows))
    return classifier.train_or_skip(merged).metrics


@query()
def curation_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run over three tables, with reviews and learning, from collection to the trained model: progress and scores."""
    documents = corpus(spark, sf_dir).select("text", "source", F.col("doc_id").alias("place"))
    turns = table(spark, sf_dir, "conversations").select(
        "text", F.concat(F.lit("chat_"), "role").alias("source"), (F.col("conv_id") * 1000 + F.col("turn")).alias("place")
    )
    items = table(spark, sf_dir, "benchmark").select("text", F.lit("benchmark").alias("source"), F.col("item_id").alias("place"))
    sources = {name: ingest.stamp(rows, F.col("source")) for name, rows in (("documents", documents), ("turns", turns), ("items", items))}
    # Reviewers confirm the language of documents of good quality; ids come from source and text.
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    reviewed = corpus(spark, sf_dir).join(good, "doc_id", "left_semi").withColumn("id", F.md5(F.concat("source", F.lit("\u0001"), "text")))
    reviews = reviewed.select(
        "id", "text", "label", F.lit(0.5).alias("confidence"), "source", F.col("label").alias("suggested_label"), F.col("label").alias("corrected_label")
    )
    at = flow.Workspace(stage_path(spark, "run"))
    result = flow.run(spark, sources, at, KEYWORDS, reviews=staged(reviews, "reviews"), iterations=2, order_by=["place"])
    history = result.learning.agg(F.count("*").alias("iterations"), F.max("n_labeled").alias("n_labeled"), F.max_by("f1_macro", "iteration").alias("learned_f1"))
    return side_by_side([result.progress, result.training.metrics, history])


@query("SELECT 0.0::DOUBLE AS accuracy, 0.0::DOUBLE AS f1_macro, 0::BIGINT AS n_train, 'training takes two classes of two rows each' AS reason FROM (SELECT count(*) FROM documents WHERE lang = 'en')")
def training_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A single class cannot be trained: zero metrics and the reason."""
    result = classifier.train_or_skip(_training(spark, sf_dir).where("label = 'en'"))
    return result.metrics.select("accuracy", "f1_macro", "n_train", F.lit(result.skipped).alias("reason"))


@query()
def learning_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active learning over all documents; the cycle keeps its labelled rows out of the pool."""
    rows = staged(_training(spark, sf_dir), "training")
    return active.run_cycle(rows, rows, "entropy")


@query()
def strategy_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories of all strategies."""
    rows = staged(_training(spark, sf_dir), "training")
    return active.compare_strategies(rows, rows)


_HISTORY = """history AS (SELECT CASE lang WHEN 'en' THEN 'entropy' WHEN 'de' THEN 'margin' ELSE 'random' END AS strategy,
  (CAST(substr(source, 4, 9) AS INT) + 1) AS iteration, count(*) AS n, round(avg(quality), 4) AS f1_macro
  FROM documents JOIN labels USING (doc_id) GROUP BY ALL),
 sized AS (SELECT strategy, iteration, f1_macro, sum(n) OVER (PARTITION BY strategy ORDER BY iteration)::BIGINT AS n_labeled FROM history)"""


@query(f"""WITH {_HISTORY}, finals AS (SELECT strategy, arg_max(f1_macro, iteration) AS final_f1 FROM sized GROUP BY strategy),
 best AS (SELECT max(final_f1) AS best_f1, arg_min(strategy, {{'a': -final_f1, 'b': strategy}}) AS best_strategy FROM finals),
 reached AS (SELECT strategy, arg_min(n_labeled, iteration) AS n_at_90 FROM sized, best WHERE f1_macro >= 0.9 * best_f1 GROUP BY strategy)
 SELECT f.strategy, final_f1, n_at_90, (SELECT n_at_90 FROM reached WHERE strategy = 'random') - n_at_90 AS saved_vs_random, f.strategy = best_strategy AS is_best
 FROM finals f LEFT JOIN reached r USING (strategy), best""")
def strategy_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best strategy and rows saved, over histories derived from labelled documents."""
    documents = table(spark, sf_dir, "documents")
    named = F.when(F.col("lang") == "en", "entropy").when(F.col("lang") == "de", "margin").otherwise("random")
    iteration = F.expr("CAST(substr(source, 4, 9) AS INT) + 1")
    history = (
        documents.join(table(spark, sf_dir, "labels"), "doc_id")
        .groupBy(named.alias("strategy"), iteration.alias("iteration"))
        .agg(F.count("*").alias("n"), F.round(F.avg("quality"), 4).alias("f1_macro"))
    )
    so_far = Window.partitionBy("strategy").orderBy("iteration")
    return active.strategy_summary(history.withColumn("n_labeled", F.sum("n").over(so_far)))
