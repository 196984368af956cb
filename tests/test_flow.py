"""A whole run on small tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from textloom.operators import labelling
from textloom.plans import flow, session
from textloom.sources import ingest


def _source(spark, name, seed, rows=60):
    random.seed(seed)
    filler = "boat crew passage harbour evening morning island weather plan route".split()
    data = []
    for i in range(rows):
        label = random.choice(list(labelling.DEFAULT_KEYWORDS))
        words = random.choices(labelling.DEFAULT_KEYWORDS[label], k=3) + random.choices(filler, k=9)
        if i % 6 == 0:
            words += [random.choice(labelling.DEFAULT_KEYWORDS["weather"])] * 2
        data.append((f"Note {seed}-{i}: " + " ".join(words), name))
    return ingest.stamp(spark.createDataFrame(data, "text string, source string"), F.col("source"))


def test_run(spark, tmp_path):
    sources = {"forum": _source(spark, "boat_forum", 1), "rss": _source(spark, "rss_x", 2)}
    first = flow.run(spark, sources, flow.Workspace(str(tmp_path / "a")), skip_learning=True)
    before = first.progress.first()
    assert before.total_rows == 120 and before.annotated_rows == before.clean_rows and before.reviewed_rows == 0
    assert first.learning is None and first.training.skipped is None
    assert first.training.metrics.first().n_train > 0

    # The queue of the first run, corrected by hand, goes into the second.
    reviews = ingest.read_review_queue(spark, str(tmp_path / "a" / "review_queue"))
    reviews = session.staged(reviews.withColumn("corrected_label", F.when(F.col("label") != "weather", F.lit("safety"))), "reviews")
    second = flow.run(spark, sources, flow.Workspace(str(tmp_path / "a")), reviews=reviews, iterations=2)
    corrected = labelling.corrected_rows(reviews).count()
    assert corrected > 0 and second.progress.first().reviewed_rows == corrected
    assert second.annotation.first().kappa_n_samples == corrected
    scores, plain = second.training.metrics.first(), first.training.metrics.first()
    assert scores.n_train + scores.n_test == plain.n_train + plain.n_test + corrected
    # The pool is the queue, which may hold less than a batch beside the rows already labelled.
    start, grown = (row.n_labeled for row in second.learning.orderBy("iteration").collect())
    assert start == 50 and start < grown <= start + 20


def test_report(spark):
    tables = flow.corpus_report(_source(spark, "boat_forum", 3), "sailing")
    assert all(frame.count() > 0 for name, frame in tables.items() if name != "issues")


def test_shared_folder_comes_from_settings():
    class Conf(dict):
        def get(self, name, *default):
            return super().get(name, *default) if default else self[name]

    class Session:
        conf = Conf({"spark.checkpoint.dir": "s3://bucket/shared/", "spark.sql.warehouse.dir": "s3://bucket/tables"})

    assert session.shared_dir(Session()) == "s3://bucket/shared"
    del Session.conf["spark.checkpoint.dir"]
    assert session.shared_dir(Session()) == "s3://bucket/tables/textloom"


def test_small_side_is_computed_once(spark):
    side = session.small_side(spark.range(10).withColumn("r", F.rand()))
    assert sorted(side.collect()) == sorted(side.collect()) and side.count() == 10
