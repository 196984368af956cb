"""Most frequent terms by bounded summaries against plain counting."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.operators import heavy


def _plain(documents, limit, low, high):
    n, docs = Counter(), Counter()
    for words in documents:
        terms = (words if low == 1 else []) + ([f"{a} {b}" for a, b in zip(words, words[1:])] if high == 2 else [])
        n.update(terms)
        docs.update({*terms})
    best = sorted(n, key=lambda t: (-n[t], t.encode()))[:limit]
    return [(None, 0, len(documents))] + [(t, n[t], docs[t]) for t in best]


def _corpus(seed: int, size: int = 400):
    rnd = random.Random(seed)
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(300)]
    draw = lambda: words[min(299, int(rnd.expovariate(1 / 30)))]
    return [[draw() for _ in range(rnd.choice([0, 1, 2, 30]))] for _ in range(size)] + [["hot", "words"] * 300] * 20


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (2, 2)])
@pytest.mark.parametrize("limit, keep", [(20, 40), (20, 10_000), (5, 6), (100_000, 64)])
def test_equals_plain_counting(spark, low, high, limit, keep):
    """Small summaries are pruned, tiny ones have to be made again, large ones are exact at once."""
    documents = _corpus(limit + keep)
    rows = spark.createDataFrame([(d,) for d in documents], "words array<string>").repartition(5)
    got = [tuple(r) for r in heavy.most_frequent(rows, limit, low, high, keep).collect()]
    assert got == _plain(documents, limit, low, high)


def test_error_bounds_every_term():
    import pyarrow as pa

    documents = _corpus(3)
    summary = heavy.Summary(25)
    for first in range(0, len(documents), 50):
        summary.add(pa.array(documents[first : first + 50], pa.list_(pa.string())), 1, 2)
    rows = [row for batch in summary.batches() for row in batch.to_pylist()]
    (head,) = [row for row in rows if row["term"] is None]
    assert head["docs"] == len(documents) and head["error"] > 0
    held = {row["term"]: row["n"] for row in rows if row["term"] is not None}
    assert len(held) <= 50
    for term, true, _ in _plain(documents, 10**9, 1, 2)[1:]:
        assert held.get(term, 0) <= true <= held.get(term, 0) + head["error"]


def test_nothing_to_count(spark):
    empty = spark.createDataFrame([], "words array<string>")
    assert [tuple(r) for r in heavy.most_frequent(empty, 10).collect()] in ([], [(None, 0, 0)])
    blank = spark.createDataFrame([(None,), ([],)], "words array<string>")
    assert [tuple(r) for r in heavy.most_frequent(blank, 10).collect()] == [(None, 0, 2)]
    with pytest.raises(ValueError):
        heavy.most_frequent(blank, 10, 1, 3)


def test_second_pass_shuffles_candidates_only(spark):
    documents = _corpus(9)
    rows = spark.createDataFrame([(d,) for d in documents], "words array<string>").repartition(4)
    counted = heavy.exact_counts(rows, ["w1", "hot words"], 1, 2)
    assert counted.where(F.col("term").isNotNull()).count() <= 2 * 4
