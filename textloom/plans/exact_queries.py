"""Queries whose SQL repeats what the larger ones are made of: near duplicates of whole names, and what a fit must satisfy.

The similarity of two texts is a dynamic programme; SQL can run it for names, not for documents. Names of
customers are texts of their own, and differ by a few digits each, so that some neighbours are near duplicates
and some are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import classifier, dedup, quality, tfidf
from textloom.plans.catalog import corpus, query, table
from textloom.plans.session import stage_path, staged
from textloom.sources import sinks


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' names as a corpus, in the order of their balances."""
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_name").alias("text"), F.col("c_mktsegment").alias("source"))


_ORDER = ["c_acctbal", "c_custkey"]

def _common(a: str, b: str) -> str:
    """Length of the longest common subsequence: a row of the programme per character, from the places where it matches."""
    return f"""list_last(list_reduce(
   list_concat([list_transform(range(len({a})), lambda x: 0)],
     list_transform(string_split({b}, ''), lambda c: list_transform(string_split({a}, ''), lambda x: CASE WHEN x = c THEN 1 ELSE 0 END))),
   lambda row, same: list_transform(
     list_transform(range(1, len(row) + 1), lambda j: list_slice(list_transform(row, lambda v, i: greatest(v, CASE WHEN same[i] = 1 THEN coalesce(row[i - 1], 0) + 1 ELSE 0 END)), 1, j)),
     lambda upto: list_max(upto))))"""


# A common beginning belongs to every longest common subsequence.
_COMMON = f"CASE WHEN left(a.text, 9) = left(b.text, 9) THEN 9 + {_common('substr(a.text, 10)', 'substr(b.text, 10)')} ELSE {_common('a.text', 'b.text')} END"


def _pairs_sql(name: str, rows: str) -> str:
    """Pairs within the window and of similarity 90 or more among ``rows`` (``pos``, ``text``)."""
    return f"""{name} AS (SELECT * FROM (
     SELECT a.pos AS pos_1, b.pos AS pos_2, a.text AS text_1, b.text AS text_2,
       (1.0 - (length(a.text) + length(b.text) - 2 * ({_COMMON})) / (length(a.text) + length(b.text))) * 100.0 AS exact
     FROM {rows} a JOIN {rows} b ON b.pos > a.pos AND b.pos <= a.pos + 49) WHERE exact >= 90.0)"""


_NAMES = f"""named AS (SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS pos, c_custkey, c_acctbal, c_name AS text FROM customer),
 {_pairs_sql('near', 'named')}"""


@query(f"WITH {_NAMES} SELECT pos_1, pos_2, text_1, text_2, round(exact, 2) AS similarity FROM near")
def near_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate pairs of names within the window, with their similarity."""
    return quality.find_fuzzy_duplicates(_names(spark, sf_dir), _ORDER)


@query(f"WITH {_NAMES} SELECT pos_1, pos_2, round(exact, 2) AS similarity FROM near ORDER BY pos_1, pos_2 LIMIT 5")
def first_near_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five pairs."""
    pairs = quality.find_fuzzy_duplicates(_names(spark, sf_dir), _ORDER).select("pos_1", "pos_2", "similarity")
    return pairs.orderBy("pos_1", "pos_2").limit(5)


@query(f"WITH {_NAMES} SELECT c_custkey, text FROM named WHERE pos NOT IN (SELECT pos_2 FROM near)")
def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names without the later one of each pair."""
    rows = dedup.with_position(_names(spark, sf_dir), _ORDER)
    return dedup.drop_fuzzy_duplicates(rows, dedup.fuzzy_pairs(rows)).select("c_custkey", "text")


_COMPARED = f"""WITH {_NAMES}, kept AS (SELECT text, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS pos FROM named WHERE pos NOT IN (SELECT pos_2 FROM near)),
 {_pairs_sql('rest', 'kept')},
 counts AS (SELECT (SELECT count(*) FROM named) AS rows_before, (SELECT count(*) FROM kept) AS rows_after,
   (SELECT count(*) FROM near) AS pairs_before, (SELECT count(*) FROM rest) AS pairs_after,
   (SELECT count(*) FROM named WHERE length(text) < 50) AS short_before, (SELECT count(*) FROM kept WHERE length(text) < 50) AS short_after,
   (SELECT round(avg(length(text)), 2) FROM named) AS len_before, (SELECT round(avg(length(text)), 2) FROM kept) AS len_after)"""


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = _names(spark, sf_dir)
    plan = {"fuzzy_duplicates": "remove", "short_texts": "keep", "long_texts": "keep"}
    after = staged(quality.clean(before, _ORDER, plan), "clean")
    return quality.compare(before, after, _ORDER)


@query(f"""{_COMPARED} SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
 round(100.0 * (rows_before - rows_after) / rows_before, 2) AS pct_removed, pairs_before AS fuzzy_duplicates_before,
 pairs_after AS fuzzy_duplicates_after, short_before AS short_texts_before, short_after AS short_texts_after,
 len_before AS avg_len_before, len_after AS avg_len_after, 0::BIGINT AS html_entities_before, 0::BIGINT AS html_entities_after,
 0::BIGINT AS duplicates_before, 0::BIGINT AS duplicates_after FROM counts""")
def names_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names before and after cleaning, near duplicates counted on both sides."""
    return _compared(spark, sf_dir)


@query(f"""{_COMPARED} SELECT unnest(['Rows', 'HTML entities', 'Short texts', 'Duplicates', 'Fuzzy duplicate pairs', 'Average text length']) AS metric,
 unnest([rows_before, 0, short_before, 0, pairs_before, len_before]::DOUBLE[]) AS before, unnest([rows_after, 0, short_after, 0, pairs_after, len_after]::DOUBLE[]) AS after FROM counts""")
def names_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison as metric rows, written and read back."""
    path = stage_path(spark, "metrics")
    rows = quality.metric_rows(_compared(spark, sf_dir))
    sinks.write_metrics(rows, path)
    return spark.read.schema(rows.schema).json(path).select("metric", "before", "after")


_MODEL = classifier.TextClassifier(tfidf=tfidf.TfidfConfig(max_features=2000, ngram_high=1), balanced=False)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with their words: taken apart once, for counting terms, fitting and predicting."""
    return staged(corpus(spark, sf_dir).select("id", "label", tfidf.words_of().alias(tfidf.WORDS)), "training")


@query("SELECT lang AS label, count(*) AS rows, count(*) AS expected_rows FROM documents GROUP BY lang")
def fitted_class_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fit without weights satisfies at its optimum: each class's probabilities add up to its rows."""
    rows = _labelled(spark, sf_dir)
    model = _MODEL.fit(rows)
    each = F.arrays_zip(F.array(*map(F.lit, model.labels)).alias("label"), F.col("probability").alias("p"))
    sums = model.predict(rows).select(F.inline(each)).groupBy("label").agg(F.round(F.sum("p")).cast("bigint").alias("expected_rows"))
    return rows.groupBy("label").agg(F.count("*").alias("rows")).join(sums, "label")


@query("SELECT lang AS label, round(count(*) OVER () / count(DISTINCT lang) OVER ()) AS expected_weight FROM documents QUALIFY row_number() OVER (PARTITION BY lang) = 1")
def fitted_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for balanced weights: they give each class the same share of all rows."""
    rows = _labelled(spark, sf_dir)
    model = classifier.TextClassifier(tfidf=_MODEL.tfidf).fit(rows)
    sizes = staged(rows.groupBy("label").agg(F.count("*").alias("n")), "sizes")
    weight = F.lit(rows.count() / len(model.labels)) / F.col("n")
    each = F.arrays_zip(F.array(*map(F.lit, model.labels)).alias("label"), F.transform("probability", lambda p: p * F.col("weight")).alias("p"))
    weighted = model.predict(rows).join(sizes, "label").withColumn("weight", weight)
    return weighted.select(F.inline(each)).groupBy("label").agg(F.round(F.sum("p")).alias("expected_weight"))


@query("SELECT count(*) AS rows, count(*) AS equal_predictions, count(*) AS equal_probabilities, count(*) AS unit_sums FROM documents")
def stored_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model written and read back predicts what it did before, and probabilities add up to one."""
    rows = _labelled(spark, sf_dir)
    model, path = _MODEL.fit(rows), stage_path(spark, "model")
    model.save(spark, path)
    again = classifier.TextModel.load(spark, path)
    both = model.predict(rows).join(again.predict(rows).select("id", F.col("prediction").alias("again"), F.col("probability").alias("p")), "id")
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    return both.agg(
        F.count("*").alias("rows"), F.count_if(F.col("prediction") == F.col("again")).alias("equal_predictions"),
        F.count_if(F.col("probability") == F.col("p")).alias("equal_probabilities"), F.count_if(F.abs(total - 1) < 1e-12).alias("unit_sums"),
    )


@query("SELECT doc_id, 'en' AS prediction, 1.0::DOUBLE AS probability FROM documents")
def single_class_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of a single class predicts it everywhere."""
    rows = corpus(spark, sf_dir)
    model = _MODEL.fit(rows.where("label = 'en'"))
    return model.predict(rows).select("doc_id", "prediction", F.col("probability")[0].alias("probability"))
