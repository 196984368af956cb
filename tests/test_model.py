"""Features, training, evaluation and active learning."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import active, classifier, metrics, prepare, softmax, split, tfidf

WORDS = {
    "navigation": "route waypoint chart tide course bearing",
    "safety": "jacket flare rescue distress watch harness",
    "equipment": "rigging anchor engine winch halyard battery",
    "weather": "wind storm forecast barometer cloud pressure",
    "licensing": "exam certificate license rule paper test",
}


def texts(label, rows, seed):
    random.seed(seed)
    shared = "the boat and crew with plan today".split()
    return [" ".join(random.sample(WORDS[label].split(), 3) + random.sample(shared, 4)) for _ in range(rows)]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(f"{label}{i}", text, label, "s") for n, label in enumerate(WORDS) for i, text in enumerate(texts(label, 12, n))]
    return spark.createDataFrame(rows, "id string, text string, label string, source string").cache()


@pytest.fixture(scope="module")
def pool(spark):
    rows = [(f"p{label}{i}", text, label, "") for n, label in enumerate(WORDS) for i, text in enumerate(texts(label, 20, 50 + n))]
    return spark.createDataFrame(rows, "id string, text string, label string, corrected_label string").cache()


def plain_tfidf(documents, limit, bigrams, sublinear):
    grams = []
    for text in documents:
        words = [word for word in text.lower().split() if len(word) > 1]
        grams.append(Counter(words + ([f"{a} {b}" for a, b in zip(words, words[1:])] if bigrams else [])))
    total, seen = sum(grams, Counter()), Counter(term for row in grams for term in row)
    terms = sorted(sorted(total, key=lambda term: (-total[term], term))[:limit])
    weights = {}
    for i, row in enumerate(grams):
        raw = {
            term: (1 + math.log(row[term]) if sublinear else row[term]) * (math.log((1 + len(documents)) / (1 + seen[term])) + 1)
            for term in row if term in set(terms)
        }
        norm = math.sqrt(sum(w * w for w in raw.values()))
        weights.update({(i, term): w / norm for term, w in raw.items()})
    return terms, weights


@pytest.mark.parametrize("limit, bigrams, sublinear", [(1000, True, True), (9, False, False), (9, True, True)])
def test_tfidf(spark, limit, bigrams, sublinear):
    documents = texts("safety", 15, 1) + ["", "solo", "boat boat boat crew"]
    rows = spark.createDataFrame(list(enumerate(documents)), "id int, text string").repartition(3)
    model = tfidf.fit_tfidf(rows, tfidf.TfidfConfig(limit, 1, 2 if bigrams else 1, sublinear))
    terms, weights = plain_tfidf(documents, limit, bigrams, sublinear)
    assert list(model.terms) == terms and model.documents == len(documents)
    got = {(row.id, row.term): row.weight for row in tfidf.tfidf_weights(rows, model).collect()}
    assert got == pytest.approx(weights)


@pytest.mark.parametrize("classes", [2, 4])
def test_softmax_reaches_the_optimum(spark, classes):
    generator = np.random.default_rng(classes)
    points, features = 120, 30
    dense = generator.random((points, features)) * (generator.random((points, features)) < 0.2) * generator.random(features) ** 3
    targets = generator.integers(0, classes, points)
    weights = generator.random(points) + 0.5
    rows = spark.createDataFrame(
        [
            (([int(j) for j in np.flatnonzero(x)], [float(v) for v in x[x != 0]]), int(t), float(w))
            for x, t, w in zip(dense, targets, weights)
        ],
        "features struct<indices: array<int>, weights: array<double>>, target int, weight double",
    ).repartition(3)
    coefficients, intercepts = softmax.fit_softmax(rows, features, classes, c=2.0, tolerance=1e-8)
    scores = dense @ coefficients.T + intercepts
    if classes == 2:
        scores = np.hstack([np.zeros((points, 1)), scores])
    chances = np.exp(scores - scores.max(axis=1, keepdims=True))
    chances /= chances.sum(axis=1, keepdims=True)
    chances[np.arange(points), targets] -= 1
    errors = (chances * weights[:, None])[:, -len(coefficients) :]
    # Gradient of 2 * sum(weight * loss) + |coefficients|^2 / 2.
    assert np.abs(2 * errors.T @ dense + coefficients).max() < 1e-4
    assert np.abs(errors.sum(axis=0)).max() < 1e-4


def test_training(spark, labelled, tmp_path):
    extra = spark.createDataFrame(
        [("o1", "off topic", prepare.REVIEW_LABEL, "s"), ("u1", "none", prepare.UNLABELED, "s"), ("r1", "rare one", "rare", "s"), ("b1", " ", "safety", "s")],
        labelled.schema,
    )
    result = classifier.train(labelled.unionByName(extra))
    scores = result.metrics.first()
    assert (scores.n_train, scores.n_test) == (48, 12) and scores.train_accuracy == 1.0 and scores.accuracy >= 0.8
    assert result.model.labels == tuple(sorted(WORDS))
    assert sorted(row.label for row in result.class_metrics.collect()) == sorted(WORDS)
    predicted = result.model.predict(labelled).collect()
    assert all(len(row.probability) == 5 and abs(sum(row.probability) - 1) < 1e-9 for row in predicted)
    assert {row.prediction for row in predicted} <= set(WORDS)
    result.model.save(spark, str(tmp_path / "model"))
    loaded = classifier.TextModel.load(spark, str(tmp_path / "model"))
    assert [row.probability for row in loaded.predict(labelled).collect()] == [row.probability for row in predicted]


@pytest.mark.parametrize("labels", [sorted(WORDS), ["navigation", "weather"]])
def test_explanations(labelled, labels):
    rows = labelled.where(F.col("label").isin(labels))
    model = classifier.TextClassifier().fit(rows)
    weights = {}
    for row in tfidf.tfidf_weights(rows, model.tfidf).collect():
        weights.setdefault(row.id, {})[row.term] = row.weight
    predictions = {row.id: row.prediction for row in model.predict(rows).collect()}
    table = model.class_coefficients()
    got = {}
    for row in model.explain(rows, n=4).orderBy("id", "rank").collect():
        assert row.label == predictions[row.id]
        got.setdefault(row.id, []).append((row.term, row.weight))
    for name, terms in got.items():
        line = table[labels.index(predictions[name])]
        parts = {term: w * line[model.tfidf.terms.index(term)] for term, w in weights[name].items()}
        best = sorted((term for term in parts if parts[term] > 0), key=lambda term: (-parts[term], term))[:4]
        assert [weight for _, weight in terms] == pytest.approx([parts[term] for term in best], abs=1e-6)


def test_explanations_shuffle_nothing(spark, labelled):
    model = classifier.TextClassifier().fit(labelled)
    explained = model.explain(labelled, n=3)
    plan = explained._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    scored = model.predict(labelled)
    rows = tfidf.transform_tfidf(scored.select("id", "text", F.lit("nowhere").alias("label")), model.tfidf)
    assert classifier.top_contributions(rows, model.tfidf, model.labels, model.class_coefficients(), "id", 3).count() == 0
    # Ties and order against the long form.
    rows = tfidf.transform_tfidf(labelled.select("id", "text", "label"), model.tfidf)
    got = {(r.id, r.rank): (r.term, r.weight) for r in classifier.top_contributions(rows, model.tfidf, model.labels, model.class_coefficients(), "id", 4).collect()}
    line = dict(zip(model.labels, model.class_coefficients()))
    for row in rows.collect():
        terms = sorted((-w * line[row.label][i], i) for i, w in zip(row.features.indices, row.features.weights) if w * line[row.label][i] > 0)
        for rank, (weight, i) in enumerate(terms[:4], 1):
            assert got[row.id, rank] == (model.tfidf.terms[i], round(-weight, 6))
    assert len(got) <= 4 * labelled.count()


def test_a_fit_may_begin_from_an_earlier_model(spark, labelled):
    few = labelled.where("id LIKE '%1%' OR id LIKE '%2%'")
    maker = classifier.TextClassifier(tfidf=tfidf.TfidfConfig(max_features=60), balanced=False)
    first, cold = maker.fit(few), maker.fit(labelled)
    moved = first.moved(cold.labels, cold.tfidf)
    at = {term: i for i, term in enumerate(first.tfidf.terms)}
    for new, term in enumerate(cold.tfidf.terms):
        assert moved[0][:, new].tolist() == (first.coefficients[:, at[term]].tolist() if term in at else [0.0] * len(cold.labels))
    warm = maker.fit(labelled, start=first)
    assert np.abs(warm.coefficients - cold.coefficients).max() < 1e-2
    chances = {r.id: r.probability for r in cold.predict(labelled).collect()}
    assert all(np.allclose(r.probability, chances[r.id], atol=1e-3) and r.prediction == r.label for r in warm.predict(labelled).collect())


def test_a_start_for_other_classes():
    spare = tfidf.TfidfModel(tfidf.QUERY_TFIDF, ("a", "b"), (1.0, 1.0), 2)
    both = classifier.TextModel(("x", "y"), spare, np.array([[1.0, 2.0]]), np.array([3.0]), None)
    more = classifier.TextModel(("x", "y", "z"), spare, np.arange(6.0).reshape(3, 2), np.arange(3.0), None)
    assert both.moved(("x", "z"), spare) is None and both.moved(more.labels, spare) is None and more.moved(both.labels, spare) is None
    assert [m.tolist() for m in both.moved(("x", "y"), spare)] == [[[1.0, 2.0]], [3.0]]
    other = tfidf.TfidfModel(tfidf.QUERY_TFIDF, ("b", "c"), (1.0, 1.0), 2)
    assert [m.tolist() for m in more.moved(("w", "y", "z"), other)] == [[[0.0, 0.0], [3.0, 0.0], [5.0, 0.0]], [0.0, 1.0, 2.0]]
    constant = classifier.TextModel(("x",), spare, None, None, "x")
    assert constant.moved(more.labels, spare) is None


def test_words_taken_apart_beforehand(spark, labelled):
    words = labelled.withColumn(tfidf.WORDS, tfidf.words_of()).withColumn("text", F.lit("nothing of this"))
    config = tfidf.TfidfConfig(50)
    assert tfidf.fit_tfidf(words, config) == tfidf.fit_tfidf(labelled, config)
    same = lambda df: {r.id: r.features for r in tfidf.transform_tfidf(df, tfidf.fit_tfidf(labelled, config)).collect()}
    assert same(words) == same(labelled)


def test_longer_terms_are_counted_too(spark):
    rows = spark.createDataFrame([("red blue red blue red",), ("red blue red",)], "text string")
    assert tfidf.fit_tfidf(rows, tfidf.TfidfConfig(2, 3, 3)).terms == ("blue red blue", "red blue red")


def test_single_class_gives_a_constant(labelled):
    model = classifier.TextClassifier().fit(labelled.where("label = 'safety'"))
    assert {(row.prediction, tuple(row.probability)) for row in model.predict(labelled).collect()} == {("safety", (1.0,))}


def test_training_is_skipped(spark, labelled):
    empty = classifier.train_or_skip(labelled.where("label = 'nothing'"))
    assert empty.skipped == "no rows are left to train on"
    one = classifier.train_or_skip(labelled.where("label = 'safety'"))
    assert one.skipped.startswith("training takes two classes") and one.metrics.first().accuracy == 0.0
    with pytest.raises(ValueError):
        prepare.trainable_rows(spark.range(1))


def test_rare_classes_stay_without_two_larger_ones(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "label string")
    assert prepare.valid_classes(rows) == ["a", "b"]
    assert prepare.valid_classes(rows.unionByName(rows.where("label = 'b'")).unionByName(rows.limit(0)).union(spark.createDataFrame([("c",)], "label string"))) == ["a", "b"]


@pytest.mark.parametrize("sizes", [{"a": 50, "b": 31, "c": 2}, {"a": 1, "b": 9}, {"a": 3000, "b": 7}])
def test_split_is_a_partition(spark, sizes):
    rows = spark.createDataFrame([(f"{label}{i}", label) for label, n in sizes.items() for i in range(n)], "id string, label string")
    flags = split.with_test_flag(rows).collect()
    total = sum(sizes.values())
    assert len(flags) == total and sum(row.is_test for row in flags) == math.ceil(round(0.2 * total, 9))
    if split.can_stratify(sizes):
        quotas = split.test_quotas(sizes)
        assert Counter(row.label for row in flags if row.is_test) == {k: v for k, v in quotas.items() if v}
    again = {row.id: row.is_test for row in split.with_test_flag(rows.repartition(7)).collect()}
    assert again == {row.id: row.is_test for row in flags}


def test_metrics(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("b", "c")] + [("d", "a")]
    counts = metrics.confusion(spark.createDataFrame(pairs, "label string, prediction string"))
    got = {row.label: row[1:] for row in metrics.class_scores(counts).collect()}
    assert got == {"a": (0.75, 0.75, 0.75, 4), "b": (0.6667, 0.6667, 0.6667, 3), "c": (0.0, 0.0, 0.0, 0), "d": (0.0, 0.0, 0.0, 1)}
    overall = metrics.overall_scores(counts).first()
    assert overall[:] == (0.625, 0.3542, 0.625, 8)
    assert {row.label: row.f1 for row in metrics.class_scores(counts, ["b", "z"]).collect()} == {"b": 0.6667, "z": 0.0}
    assert metrics.overall_scores(counts.limit(0)).first()[:] == (0.0, 0.0, 0.0, 0)


@pytest.mark.parametrize("strategy", ["entropy", "margin", "random", "unknown"])
def test_query(labelled, pool, strategy):
    model = active.QUERY_CLASSIFIER.fit(labelled)
    chosen = active.query(model, pool, strategy, 10)
    assert chosen.count() == 10 and chosen.columns == pool.columns
    assert active.query(model, pool.limit(4), strategy, 10).count() == 4
    if strategy == "margin":
        scored = model.predict(pool).select("id", active.margin(F.col("probability")).alias("m")).orderBy(F.round("m", 12), "id").limit(10)
        assert {row.id for row in scored.collect()} == {row.id for row in chosen.collect()}


def test_uncertainty(spark):
    rows = spark.createDataFrame([([0.5, 0.5],), ([1.0],), ([0.7, 0.2, 0.1],)], "p array<double>")
    got = rows.select(active.entropy(F.col("p")), active.margin(F.col("p"))).collect()
    for row, p in zip(got, ([0.5, 0.5], [1.0], [0.7, 0.2, 0.1])):
        ordered = sorted(p, reverse=True)
        assert row[0] == pytest.approx(-sum(x * math.log(x + 1e-10) for x in p))
        assert row[1] == pytest.approx(0 if len(p) == 1 else ordered[0] - ordered[1])


def test_initial_sample(labelled):
    sample = active.initial_sample(labelled, 20).collect()
    assert len({row.id for row in sample}) == 20 and {row.label for row in sample} == set(WORDS)
    assert active.initial_sample(labelled, 2).count() == len(WORDS)


def test_cycle_and_summary(spark, labelled, pool):
    history = active.run_cycle(labelled, pool, "margin", iterations=3, batch_size=10, initial_size=30)
    rows = history.orderBy("iteration").collect()
    assert [(row.iteration, row.n_labeled, row.strategy) for row in rows] == [(1, 30, "margin"), (2, 40, "margin"), (3, 50, "margin")]
    assert active.run_cycle(labelled.limit(0), pool, iterations=1).count() == 0
    short = active.run_cycle(labelled, pool.limit(3), "random", iterations=4, batch_size=10, initial_size=30)
    assert [row.n_labeled for row in short.orderBy("iteration").collect()] == [30, 33]


def test_strategy_summary(spark):
    history = spark.createDataFrame(
        [(i, 10 * i, 0.0, f1, name) for name, scores in {"random": [0.1, 0.2, 0.5], "margin": [0.48, 0.3, 0.5], "entropy": [0.1, 0.1, 0.2]}.items() for i, f1 in enumerate(scores, 1)],
        active.HISTORY_SCHEMA,
    )
    got = {row.strategy: row[1:] for row in active.strategy_summary(history).collect()}
    assert got == {"random": (0.5, 30, 0, False), "margin": (0.5, 10, 20, True), "entropy": (0.2, None, None, False)}


def test_evaluate_on_given_rows(labelled, pool):
    model, scores, per_class = active.evaluate(labelled, pool)
    row = scores.first()
    assert (row.n_train, row.n_test) == (60, 100) and row.accuracy > 0.7
    assert per_class.count() == 5
    few = active.evaluate(labelled.limit(3))[1].first()
    assert (few.n_train, few.n_test) == (3, 3)


def test_pool_resolution(spark):
    rows = spark.createDataFrame([("t", "a", " b "), ("t", "a", ""), ("t", None, None), (" ", "a", "b")], "text string, label string, corrected_label string")
    got = prepare.prepare_pool(rows, ["label", "corrected_label"])
    assert sorted(row.label for row in got.collect()) == ["", "a", "b"] and {row.id for row in got.collect()} == {"1", "2", "3"}


def test_split_keeps_quotas_with_repeated_ids(spark):
    rows = spark.range(400).selectExpr("cast(id % 200 as string) AS id", "if(id % 2 = 0, 'a', 'b') AS label", "cast(id AS string) AS text")
    flagged = split.with_test_flag(rows)
    assert {row[0]: row[1] for row in flagged.where("is_test").groupBy("label").count().collect()} == {"a": 40, "b": 40}
    assert flagged.columns == ["id", "label", "text", "is_test"]


def test_cycle_never_queries_what_is_labelled(spark, labelled):
    history = active.run_cycle(labelled, labelled, "random", iterations=2, batch_size=100, initial_size=30)
    assert [row.n_labeled for row in history.orderBy("iteration").collect()] == [30, 60]


def test_training_takes_texts_apart_once(labelled, monkeypatch):
    seen, fit, predict = [], classifier.fit_tfidf, classifier.TextModel.predict
    monkeypatch.setattr(classifier, "fit_tfidf", lambda df, *rest: seen.append(df) or fit(df, *rest))
    monkeypatch.setattr(classifier.TextModel, "predict", lambda model, df, *rest: seen.append(df) or predict(model, df, *rest))
    assert classifier.train(labelled).metrics.first()["n_test"] == 12
    assert [tfidf.WORDS in df.columns and "text" not in df.columns for df in seen] == [True, True]


def test_strategies_share_the_written_pool(spark, labelled, pool, monkeypatch):
    written, real = [], active.staged
    monkeypatch.setattr(active, "staged", lambda df, name: written.append((name, df.columns)) or real(df, name))
    history = active.compare_strategies(labelled, pool, ("margin", "random"), iterations=2, batch_size=10, initial_size=30).collect()
    assert [columns for name, columns in written if name == "pool"] == [["id", "text", "label", tfidf.WORDS, active.ROW]]
    assert [(row.strategy, row.n_labeled) for row in history] == [("margin", 30), ("margin", 40), ("random", 30), ("random", 40)]


def test_rows_that_share_an_id_are_queried_one_by_one(spark):
    rows = [("a", "wind storm", "x"), ("a", "rescue flare", "y"), ("b", "anchor winch", "x"), (None, "chart tide", "y")]
    pool = active.taken_apart(spark.createDataFrame(rows, "id string, text string, label string"))
    assert active.query(None, pool, "random", 1).count() == 1 and active.query(None, pool, "random", 9).count() == 4


def test_fitted_rows_are_taken_apart_once(spark, tmp_path):
    from textloom.plans import exact_queries

    documents = [(i, text, label, "src0") for label in ("safety", "weather") for i, text in enumerate(texts(label, 20, 3))]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = exact_queries._labelled(spark, str(tmp_path))
    assert rows.columns == ["id", "label", tfidf.WORDS]
    settings = exact_queries._MODEL
    plain = spark.createDataFrame([(text, label) for _, text, label, _ in documents], "text string, label string")
    own, other = settings.fit(rows), settings.fit(plain)
    assert own.tfidf == other.tfidf and own.coefficients == pytest.approx(other.coefficients, abs=1e-3)


def test_rows_without_any_term_have_the_chances_of_the_intercepts(spark):
    rows = spark.createDataFrame([(([], []),)] * 3, "features struct<indices:array<int>,weights:array<double>>").coalesce(1)
    got = rows.select(softmax.probabilities(F.col("features"), np.zeros((3, 4)), np.log([1.0, 2.0, 5.0])).alias("p")).collect()
    assert [row.p for row in got] == [pytest.approx([0.125, 0.25, 0.625])] * 3
