"""TF-IDF and logistic regression: training, prediction, explanation, storage."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import prepare
from textloom.operators.frames import side_by_side
from textloom.operators.metrics import class_scores, confusion, overall_scores
from textloom.operators.softmax import entries, fit_softmax, probabilities
from textloom.operators.split import SEED, TEST_SIZE, with_test_flag
from textloom.operators.tfidf import (
    MODEL_TFIDF,
    WORDS,
    TfidfConfig,
    TfidfModel,
    fit_tfidf,
    transform_tfidf,
    words_of,
)
from textloom.plans.session import staged


_ROWS_PER_TASK = 500


class NotTrainable(ValueError):
    """The rows do not allow training; the message says why."""


@dataclass(frozen=True)
class TextClassifier:
    """Settings of the classifier. Defaults are those of the final model."""

    tfidf: TfidfConfig = MODEL_TFIDF
    balanced: bool = True
    c: float = 1.0
    max_iter: int = 1000

    def fit(
        self, df: DataFrame, text_col: str = "text", label_col: str = "label", start: TextModel | None = None
    ) -> TextModel:
        """Fit on labelled rows. A single class gives a model that always predicts it.

        An earlier model may be given to start from. The objective is strictly convex in the coefficients,
        so the result is the same, within the tolerance, and only the number of passes differs."""
        counts = {row[0]: row[1] for row in df.groupBy(label_col).count().collect()}
        if not counts:
            raise NotTrainable("no labelled rows to fit")
        labels = sorted(counts)
        tfidf = fit_tfidf(df, self.tfidf, text_col)
        if len(labels) == 1 or not tfidf.terms:
            return TextModel(tuple(labels), tfidf, None, None, max(labels, key=lambda label: counts[label]))
        total = sum(counts.values())
        weights = [total / (len(labels) * counts[label]) if self.balanced else 1.0 for label in labels]
        place = F.array_position(F.array(*map(F.lit, labels)), F.col("_label")).cast("int")
        # Every pass runs one task per partition; a small training set needs only a few.
        kept = [c for c in (text_col, WORDS) if c in df.columns]
        source = df.select(*kept, F.col(label_col).alias("_label")).coalesce(max(1, math.ceil(total / _ROWS_PER_TASK)))
        rows = transform_tfidf(source, tfidf, text_col).select(
            "features",
            (place - 1).alias("target"),
            F.element_at(F.array(*map(F.lit, weights)), place).alias("weight"),
        )
        first = start.moved(tuple(labels), tfidf) if start is not None else None
        coefficients, intercepts = fit_softmax(rows, len(tfidf.terms), len(labels), self.c, self.max_iter, start=first)
        return TextModel(tuple(labels), tfidf, coefficients, intercepts, None)


@dataclass(frozen=True)
class TextModel:
    """A fitted classifier: sorted labels, vocabulary and coefficients (or one constant label).

    Two classes share one row of coefficients, which speaks for the second.
    """

    labels: tuple[str, ...]
    tfidf: TfidfModel
    coefficients: np.ndarray | None
    intercepts: np.ndarray | None
    constant: str | None

    def predict(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """Add ``prediction`` and ``probability``, the latter in the order of ``labels``."""
        if self.coefficients is None:
            chances = [1.0 if label == self.constant else 0.0 for label in self.labels]
            return df.withColumns({"prediction": F.lit(self.constant), "probability": F.array(*map(F.lit, chances))})
        return self._score(transform_tfidf(df, self.tfidf, text_col, "_features")).drop("_features")

    def _score(self, rows: DataFrame) -> DataFrame:
        best = F.array_position("probability", F.array_max("probability")).cast("int")
        return rows.withColumn(
            "probability", probabilities(F.col("_features"), self.coefficients, self.intercepts)
        ).withColumn("prediction", F.element_at(F.array(*map(F.lit, self.labels)), best))

    def moved(self, labels: tuple[str, ...], tfidf: TfidfModel) -> tuple[np.ndarray, np.ndarray] | None:
        """Coefficients and intercepts for another vocabulary and other classes; what is new starts at zero.

        ``None`` where the model has none, or only one of the two has a single row for two classes."""
        if self.coefficients is None or (len(labels) == 2) != (len(self.labels) == 2):
            return None
        if len(labels) == 2 and labels != self.labels:
            return None
        lines = 1 if len(labels) == 2 else len(labels)
        coefficients, intercepts = np.zeros((lines, len(tfidf.terms))), np.zeros(lines)
        place = {term: at for at, term in enumerate(self.tfidf.terms)}
        pairs = [(place[term], at) for at, term in enumerate(tfidf.terms) if term in place]
        old, new = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        line_of = {label: at for at, label in enumerate(self.labels)}
        for at, label in enumerate(labels if lines > 1 else labels[:1]):
            line = 0 if lines == 1 else line_of.get(label)
            if line is not None:
                coefficients[at, new], intercepts[at] = self.coefficients[line, old], self.intercepts[line]
        return coefficients, intercepts

    def class_coefficients(self) -> np.ndarray:
        """One row per class."""
        if self.coefficients is None:
            return np.zeros((len(self.labels), len(self.tfidf.terms)))
        return self.coefficients if len(self.coefficients) > 1 else np.vstack([-self.coefficients, self.coefficients])

    def explain(self, df: DataFrame, id_col: str = "id", n: int = 10, text_col: str = "text") -> DataFrame:
        """The ``n`` terms that speak most for each row's prediction: id, label, rank, term, weight."""
        if self.coefficients is None:
            return df.sparkSession.createDataFrame([], _explanation_schema(df, id_col))
        kept = [c for c in (id_col, text_col, WORDS) if c in df.columns]
        rows = self._score(transform_tfidf(df.select(*kept), self.tfidf, text_col, "_features"))
        return top_contributions(
            rows.select(id_col, F.col("prediction").alias("label"), F.col("_features").alias("features")),
            self.tfidf, self.labels, self.class_coefficients(), id_col, n,
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Store header, vocabulary and coefficients as tables under one path."""
        config = self.tfidf.config
        header = {
            "labels": list(self.labels),
            "constant": self.constant,
            "documents": self.tfidf.documents,
            "config": [config.max_features, config.ngram_low, config.ngram_high, config.sublinear],
            "intercepts": None if self.intercepts is None else self.intercepts.tolist(),
        }
        spark.createDataFrame([(json.dumps(header),)], "value string").write.mode("overwrite").text(f"{path}/header")
        lines = np.zeros((0, len(self.tfidf.terms))) if self.coefficients is None else self.coefficients
        rows = zip(range(len(self.tfidf.terms)), self.tfidf.terms, self.tfidf.idf, lines.T.tolist())
        terms = spark.createDataFrame(list(rows), "term_index int, term string, idf double, coefficients array<double>")
        terms.write.mode("overwrite").parquet(f"{path}/terms")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TextModel:
        header = json.loads(spark.read.text(f"{path}/header").first()[0])
        rows = sorted(spark.read.parquet(f"{path}/terms").collect(), key=lambda row: row["term_index"])
        tfidf = TfidfModel(
            TfidfConfig(*header["config"]),
            tuple(row["term"] for row in rows),
            tuple(row["idf"] for row in rows),
            header["documents"],
        )
        fitted = header["constant"] is None
        return TextModel(
            tuple(header["labels"]),
            tfidf,
            np.array([row["coefficients"] for row in rows]).T.copy() if fitted else None,
            np.array(header["intercepts"]) if fitted else None,
            header["constant"],
        )


def _explanation_schema(df: DataFrame, id_col: str) -> str:
    kind = dict(df.dtypes)[id_col]
    return f"{id_col} {kind}, label string, rank int, term string, weight double"


def top_contributions(
    rows: DataFrame, tfidf: TfidfModel, labels: Sequence[str], coefficients: np.ndarray, id_col: str, n: int
) -> DataFrame:
    """Largest positive ``weight * coefficient`` terms of each row for its label; ties in alphabetical order.

    A row's terms are weighted and ranked where the row lies, so nothing is shuffled. The coefficients
    are sent to all tasks; classes times ``max_features`` bounds them. Rows whose label the model does not
    know have no terms.
    """
    sent = rows.sparkSession.sparkContext.broadcast((list(tfidf.terms), np.asarray(coefficients)))
    own = F.array_position(F.array(*map(F.lit, labels)), F.col("label")).cast("int")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = sent.value
        names = pa.array(names, pa.string())
        for batch in batches:
            sizes, indices, values = entries(batch.column("features"))
            line = pc.fill_null(batch.column("own"), 0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            weight = np.where(line[row] > 0, values * table[line[row] - 1, indices], 0.0)
            at = np.flatnonzero(weight > 0)
            # Indices follow the terms' order.
            at = at[np.lexsort((indices[at], -weight[at], row[at]))]
            starts = np.flatnonzero(np.concatenate([[True], row[at][1:] != row[at][:-1]])) if len(at) else at
            place = np.arange(len(at)) - np.repeat(starts, np.diff([*starts, len(at)]))
            at, place = at[place < n], place[place < n]
            own_rows = batch.select([id_col, "label"]).take(pa.array(row[at]))
            columns = [*own_rows.columns, pa.array(place + 1, pa.int32()), names.take(pa.array(indices[at])), pa.array(weight[at])]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "label", "rank", "term", "weight"])

    ranked = rows.select(id_col, "label", "features", own.alias("own")).mapInArrow(rank, _explanation_schema(rows, id_col))
    return ranked.withColumn("weight", F.round("weight", 6))


@dataclass(frozen=True)
class TrainingResult:
    model: TextModel | None
    metrics: DataFrame
    class_metrics: DataFrame | None = None
    skipped: str | None = None


def train(
    df: DataFrame,
    text_col: str = "text",
    label_col: str = "label",
    id_col: str = "id",
    review_label: str | None = prepare.REVIEW_LABEL,
    classifier: TextClassifier = TextClassifier(),
    test_size: float = TEST_SIZE,
    seed: int = SEED,
) -> TrainingResult:
    """Select trainable rows, split, fit, evaluate on the held-out rows."""
    rows = staged(prepare.trainable_rows(df, text_col, label_col, review_label), "training")
    classes = prepare.valid_classes(rows, label_col)
    if not classes:
        raise NotTrainable("no rows are left to train on")
    if len(classes) < 2:
        raise NotTrainable("training takes two classes of two rows each")
    rows = rows.where(F.col(label_col).isin(classes))
    flagged = with_test_flag(rows, label_col, id_col, test_size, seed)
    # Split and taken apart once: counting terms, weighting rows and predicting read the words.
    words = F.col(WORDS) if WORDS in flagged.columns else words_of(text_col)
    flagged = staged(flagged.select(label_col, "is_test", words.alias(WORDS)), "words")
    training, held_out = flagged.where("NOT is_test"), flagged.where("is_test")
    model = classifier.fit(training, text_col, label_col)
    scored = staged(
        model.predict(flagged, text_col).select(label_col, "prediction", "is_test"),
        "predictions",
    )
    counts = confusion(scored.where("is_test"), label_col)
    hits = F.avg((F.col(label_col) == F.col("prediction")).cast("int"))
    fitted = scored.where("NOT is_test").agg(F.round(hits, 4).alias("train_accuracy"), F.count("*").alias("n_train"))
    metrics = side_by_side([overall_scores(counts), fitted])
    return TrainingResult(model, metrics, class_scores(counts, model.labels))


def train_or_skip(df: DataFrame, **settings) -> TrainingResult:
    """As :func:`train`; rows that do not allow training give zero metrics and the reason."""
    try:
        return train(df, **settings)
    except NotTrainable as reason:
        zeros = df.sparkSession.createDataFrame(
            [(0.0, 0.0, 0.0, 0, 0.0, 0)],
            "accuracy double, f1_macro double, f1_weighted double, n_test bigint, train_accuracy double, n_train bigint",
        )
        return TrainingResult(None, zeros, None, str(reason))
