"""Active learning: seeds, queries, the learning cycle and strategy comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators import prepare
from textloom.operators.classifier import NotTrainable, TextClassifier, TextModel
from textloom.operators.dedup import keep_first
from textloom.operators.frames import side_by_side
from textloom.operators.metrics import class_scores, confusion, overall_scores
from textloom.operators.split import SEED, random_rows, with_test_flag
from textloom.operators.tfidf import QUERY_TFIDF, WORDS, words_of
from textloom.plans.session import small_side, staged

STRATEGIES = ("entropy", "margin", "random")
# Defaults of the learning cycle.
INITIAL_SIZE = 50
BATCH_SIZE = 20
ITERATIONS = 5
QUERY_CLASSIFIER = TextClassifier(tfidf=QUERY_TFIDF, balanced=False)

#: Number of a row in a written pool.
ROW = "_row"

HISTORY_SCHEMA = "iteration int, n_labeled bigint, accuracy double, f1_macro double, strategy string"


def resolve_strategy(name: str | None, default: str = "entropy") -> str:
    chosen = str(name or default).strip().lower()
    return chosen if chosen in STRATEGIES else "entropy"


def entropy(probability: Column) -> Column:
    """Uncertainty; the small constant inside the logarithm is part of the definition."""
    return F.aggregate(probability, F.lit(0.0), lambda total, p: total - p * F.log(p + F.lit(1e-10)))


def margin(probability: Column) -> Column:
    """Best minus second-best probability; zero with a single class."""
    ordered = F.sort_array(probability, asc=False)
    return F.when(F.size(probability) < 2, F.lit(0.0)).otherwise(ordered[0] - ordered[1])


def select_uncertain(scored: DataFrame, strategy: str, n: int, id_col: str = "id", seed: int = SEED) -> DataFrame:
    """The ``n`` rows to label next, from rows with a ``probability``; ties by id.

    Scores that differ only in the last digits of their arithmetic count as ties. Each task keeps its own best ``n``; the pool is never sorted as a whole.
    """
    n = max(1, n)
    if strategy == "random":
        return random_rows(scored, n, id_col, seed)
    score = -entropy(F.col("probability")) if strategy == "entropy" else margin(F.col("probability"))
    return scored.orderBy(F.round(score, 12), id_col).limit(n)


def query(
    model: TextModel | None, pool: DataFrame, strategy: str = "entropy", n: int = BATCH_SIZE, id_col: str = "id"
) -> DataFrame:
    """Most informative pool rows under the strategy, without the model's columns.

    Of a pool that :func:`taken_apart` wrote, only ids and words are scored; the chosen rows are read by their numbers."""
    strategy = resolve_strategy(strategy)
    if ROW in pool.columns:
        if strategy == "random":
            chosen = random_rows(pool.select(id_col, ROW), max(1, n), id_col)
        else:
            chosen = select_uncertain(model.predict(pool.select(id_col, ROW, WORDS)), strategy, n, id_col)
        return pool.where(F.col(ROW).isin([row[0] for row in chosen.select(ROW).collect()]))
    pool = prepare.prepare_pool(pool, id_col=id_col)
    if strategy == "random":
        return random_rows(pool, max(1, n), id_col)
    return select_uncertain(model.predict(pool), strategy, n, id_col).select(*pool.columns)


def initial_sample(df: DataFrame, n: int = INITIAL_SIZE, id_col: str = "id", seed: int = SEED) -> DataFrame:
    """First row of every class, then random rows up to ``n``; more classes than ``n`` all stay."""
    first = staged(keep_first(df, F.col("label"), [id_col]), "seed")
    missing = max(n - first.count(), 0)
    if missing == 0:
        return first
    rest = df.join(small_side(first.select(id_col)), id_col, "left_anti")
    return first.unionByName(random_rows(rest, missing, id_col, seed))


def _holdout(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """80/20 split; under five rows, both sides are the whole frame."""
    counts = {row[0]: row[1] for row in df.groupBy("label").count().collect()}
    rows = sum(counts.values())
    if rows < 5:
        return df, df
    stratify = min(counts.values()) >= 2 and len(counts) >= 2 and max(1, round(rows * 0.2)) >= len(counts)
    flagged = with_test_flag(df, "label", id_col, stratify=stratify)
    return flagged.where("NOT is_test").drop("is_test"), flagged.where("is_test").drop("is_test")


def evaluate(
    labeled: DataFrame,
    test: DataFrame | None = None,
    id_col: str = "id",
    classifier: TextClassifier = QUERY_CLASSIFIER,
    start: TextModel | None = None,
) -> tuple[TextModel, DataFrame, DataFrame]:
    """Fit on the training part and score the rest: model, one row of metrics, scores per class.

    The fit may begin from an earlier model."""
    rows = prepare.prepare_training(labeled)
    training, held_out = _holdout(rows, id_col) if test is None else (rows, prepare.prepare_training(test))
    model = classifier.fit(training, start=start)
    counts = confusion(staged(model.predict(held_out).select("label", "prediction"), "holdout"))
    metrics = side_by_side([overall_scores(counts), training.agg(F.count("*").alias("n_train"))])
    return model, metrics, class_scores(counts)


def taken_apart(pool: DataFrame, id_col: str = "id") -> DataFrame:
    """The pool as the cycle reads it, with its words and numbered rows, written once."""
    pool = prepare.prepare_pool(pool, id_col=id_col)
    return staged(pool.select(id_col, "text", "label", words_of().alias(WORDS), F.monotonically_increasing_id().alias(ROW)), "pool")


def seeds(labeled: DataFrame, initial_size: int = INITIAL_SIZE, id_col: str = "id") -> DataFrame:
    """The rows that a cycle starts from, with their words, written once."""
    rows = prepare.prepare_training(labeled)
    first = rows if rows.limit(initial_size).count() < initial_size else initial_sample(rows, initial_size, id_col)
    return staged(first.withColumn(WORDS, words_of()).select(id_col, "text", "label", WORDS), "labelled")


def run_cycle(
    labeled: DataFrame,
    pool: DataFrame,
    strategy: str = "entropy",
    iterations: int = ITERATIONS,
    batch_size: int = BATCH_SIZE,
    initial_size: int = INITIAL_SIZE,
    id_col: str = "id",
    classifier: TextClassifier = QUERY_CLASSIFIER,
    first: DataFrame | None = None,
) -> DataFrame:
    """The learning cycle: evaluate, query, move the queried rows over. One history row each.

    As in the reference, the query uses the model that was fitted on the training part of the
    split, and queried rows without a label stay out of the next fit. The pool is taken apart into words
    and written once, unless :func:`taken_apart` did so; ``first`` may be what :func:`seeds` gave. Each fit starts from the coefficients of the one before. The ids of the first
    labelled rows, where the pool has ids of its own, and of the queried ones, at most
    ``initial_size + iterations * batch_size`` (or one per class), are kept out by an anti-join. The
    labelled rows are written once per iteration, which cuts their lineage.
    """
    strategy = resolve_strategy(strategy)
    own_ids = id_col in pool.columns
    columns = [id_col, "text", "label", WORDS]
    if ROW not in pool.columns:
        pool = taken_apart(pool, id_col) if iterations > 2 else prepare.prepare_pool(pool, id_col=id_col).withColumn(WORDS, words_of())
    current = seeds(labeled, initial_size, id_col) if first is None else first
    id_kind = dict(pool.dtypes)[id_col]
    id_schema = f"{id_col} {id_kind}"
    known = current.select(F.col(id_col).cast(id_kind)).where(F.col(id_col).isNotNull())
    queried_ids: list = [row[0] for row in known.collect()] if own_ids else []
    history, model = [], None
    spark = pool.sparkSession
    for iteration in range(1, iterations + 1):
        try:
            model, metrics, _ = evaluate(current, None, id_col, classifier, model)
        except NotTrainable:
            break
        scores = metrics.first()
        history.append((iteration, current.count(), scores["accuracy"], scores["f1_macro"], strategy))
        if iteration == iterations:
            break
        left = pool
        if queried_ids:
            left = pool.join(F.broadcast(spark.createDataFrame([(i,) for i in queried_ids], id_schema)), id_col, "left_anti")
        chosen = staged(query(model, left, strategy, batch_size, id_col).select(*columns), "queried")
        new_ids = [row[0] for row in chosen.select(id_col).collect()]
        if not new_ids:
            break
        queried_ids += new_ids
        current = staged(current.unionByName(chosen), "labelled")
    return spark.createDataFrame(history, HISTORY_SCHEMA)


def compare_strategies(
    labeled: DataFrame, pool: DataFrame, strategies: Sequence[str] = STRATEGIES, **settings
) -> DataFrame:
    """Histories of the cycle under each strategy; all read the same written pool and start from the same rows."""
    id_col = settings.get("id_col", "id")
    pool, first = taken_apart(pool, id_col), seeds(labeled, settings.get("initial_size", INITIAL_SIZE), id_col)
    result = None
    for strategy in strategies:
        history = run_cycle(labeled, pool, strategy, first=first, **settings)
        result = history if result is None else result.unionByName(history)
    return result


def strategy_summary(history: DataFrame) -> DataFrame:
    """Per strategy: final F1, first size that reaches 90 % of the best final F1, rows saved
    against random, and whether it is the best one (earlier strategies win ties)."""
    order = F.array_position(F.array(*map(F.lit, STRATEGIES)), F.col("strategy"))
    finals = small_side(history.groupBy("strategy").agg(F.max_by("f1_macro", "iteration").alias("final_f1")))
    best = finals.agg(
        F.max("final_f1").alias("f1"), F.min_by("strategy", F.struct(-F.col("final_f1"), order)).alias("strategy")
    ).first()
    enough = F.col("f1_macro") >= F.lit(0.9) * F.lit(best["f1"])
    reached = small_side(
        history.groupBy("strategy").agg(F.min_by("n_labeled", F.when(enough, F.col("iteration"))).alias("n_at_90"))
    )
    random = reached.where("strategy = 'random'").first()
    random_n = F.lit(None if random is None else random["n_at_90"]).cast("bigint")
    return finals.join(reached, "strategy").select(
        "strategy",
        "final_f1",
        "n_at_90",
        (random_n - F.col("n_at_90")).alias("saved_vs_random"),
        (F.col("strategy") == F.lit(best["strategy"])).alias("is_best"),
    )
