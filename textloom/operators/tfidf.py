"""TF-IDF over word n-grams.

Fitting is one pass with one shuffle, on terms, combined on the map side. Transforming is a map:
every row is weighted where it lies.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import model_tokens, ngrams
from textloom.operators.heavy import most_frequent

#: Column of a frame whose texts were taken apart beforehand.
WORDS = "_words"


@dataclass(frozen=True)
class TfidfConfig:
    """Analyser settings. The vocabulary is the only thing that reaches the driver, and
    ``max_features`` bounds it."""

    max_features: int = 10_000
    ngram_low: int = 1
    ngram_high: int = 2
    sublinear: bool = True


# The final classifier and the active-learning model.
MODEL_TFIDF = TfidfConfig()
QUERY_TFIDF = TfidfConfig(max_features=5000, ngram_low=1, ngram_high=1, sublinear=False)


@dataclass(frozen=True)
class TfidfModel:
    config: TfidfConfig
    terms: tuple[str, ...]
    idf: tuple[float, ...]
    documents: int

    @cached_property
    def counter(self) -> CountVectorizerModel:
        """Term counts of a token array. Handing the vocabulary to the JVM is slow: done once."""
        return CountVectorizerModel.from_vocabulary(list(self.terms), inputCol="_terms", outputCol="_tf")


def words_of(text_col: str = "text") -> Column:
    """The words of a text, none for a null."""
    return model_tokens(F.coalesce(F.col(text_col), F.lit("")))


def with_terms(df: DataFrame, config: TfidfConfig, text_col: str = "text", name: str = "_terms") -> DataFrame:
    """Add the terms of every text. A frame that has its words as ``WORDS`` is not tokenised again."""
    words = F.col(WORDS) if WORDS in df.columns else words_of(text_col)
    df = df.withColumn(name, words)
    return df.withColumn(name, ngrams(F.col(name), config.ngram_low, config.ngram_high))


def term_counts(df: DataFrame, config: TfidfConfig, text_col: str = "text") -> DataFrame:
    """Occurrences and documents per term; the row of the null term counts the documents.

    A document emits each occurrence once and each distinct term once more. Both counts are then
    sums by term, so no (document, term) pair is ever shuffled.
    """
    entry = lambda term, n, docs: F.struct(
        term.alias("term"), F.lit(n).alias("n"), F.lit(docs).alias("docs")
    )
    terms = with_terms(df, config, text_col).select("_terms")
    emitted = F.concat(
        F.array(entry(F.lit(None).cast("string"), 0, 1)),
        F.transform("_terms", lambda term: entry(term, 1, 0)),
        F.transform(F.array_distinct("_terms"), lambda term: entry(term, 0, 1)),
    )
    return (
        terms.select(F.inline(emitted))
        .groupBy("term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def _most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The null term, then the most frequent terms; ties in alphabetical order."""
    return counts.orderBy(F.col("term").isNotNull(), F.desc("n"), "term").limit(limit + 1)


def vocabulary(df: DataFrame, config: TfidfConfig, text_col: str = "text") -> DataFrame:
    """The null term, then the most frequent terms; ties in alphabetical order.

    Words and pairs are counted in bounded summaries; longer terms one by one."""
    if config.ngram_high > 2:
        return _most_frequent(term_counts(df, config, text_col), config.max_features)
    words = df.select(F.col(WORDS) if WORDS in df.columns else words_of(text_col).alias(WORDS))
    return most_frequent(words, config.max_features, config.ngram_low, config.ngram_high)


def fit_tfidf(df: DataFrame, config: TfidfConfig = MODEL_TFIDF, text_col: str = "text") -> TfidfModel:
    rows = vocabulary(df, config, text_col).collect()
    documents = next((row["docs"] for row in rows if row["term"] is None), 0)
    terms = sorted((row["term"], row["docs"]) for row in rows if row["term"] is not None)
    return TfidfModel(
        config,
        tuple(term for term, _ in terms),
        tuple(math.log((1 + documents) / (1 + docs)) + 1.0 for _, docs in terms),
        documents,
    )


def _unit_length(weights: Column) -> Column:
    """The array scaled to length one. The norm is repeated into an array, because as a plain
    value the optimiser would move its computation into the loop over the elements."""
    norm = F.sqrt(F.aggregate(weights, F.lit(0.0), lambda total, w: total + w * w))
    return F.zip_with(weights, F.array_repeat(norm, F.size(weights)), lambda w, length: w / length)


def transform_tfidf(df: DataFrame, model: TfidfModel, text_col: str = "text", name: str = "features") -> DataFrame:
    """Add the L2-normalised weights of every row as parallel arrays ``indices, weights``."""
    if not model.terms:
        empty = F.struct(F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("weights"))
        return df.withColumn(name, empty)
    counted = model.counter.transform(with_terms(df, model.config, text_col))
    # A constant array: parsed once by the optimiser, then indexed in place.
    idf = F.from_json(F.lit(json.dumps(model.idf)), "array<double>")
    damp = (lambda tf: 1.0 + F.log(tf)) if model.config.sublinear else (lambda tf: tf)
    raw = F.unwrap_udt("_tf")
    return (
        counted.withColumn("_indices", raw["indices"])
        .withColumn("_weights", F.zip_with("_indices", raw["values"], lambda index, tf: damp(tf) * F.get(idf, index)))
        .withColumn(name, F.struct(F.col("_indices").alias("indices"), _unit_length(F.col("_weights")).alias("weights")))
        .drop("_terms", "_tf", "_indices", "_weights")
    )


def tfidf_weights(df: DataFrame, model: TfidfModel, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Long form: one row per document and vocabulary term that occurs in it."""
    rows = transform_tfidf(df.select(id_col, text_col), model, text_col)
    return (
        rows.select(id_col, F.explode(F.arrays_zip("features.indices", "features.weights")).alias("_e"))
        .select(id_col, F.col("_e.indices").alias("term_index"), F.col("_e.weights").alias("weight"))
        .join(F.broadcast(model_terms(df, model)), "term_index")
        .select(id_col, "term", "weight")
    )


def model_terms(df: DataFrame, model: TfidfModel) -> DataFrame:
    """The vocabulary as a table; ``max_features`` bounds its size."""
    return df.sparkSession.createDataFrame(
        [(index, term, idf) for index, (term, idf) in enumerate(zip(model.terms, model.idf))],
        "term_index int, term string, idf double",
    )
