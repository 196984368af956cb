"""Keep-first, positions and near duplicates against brute force."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions.text import dedup_key
from textloom.operators import dedup


def subsequence(left, right):
    row = [0] * (len(right) + 1)
    for a in left:
        before = 0
        for j, b in enumerate(right):
            row[j + 1], before = (before + 1 if a == b else max(row[j], row[j + 1])), row[j + 1]
    return row[-1]


def ratio(left, right):
    total = len(left) + len(right)
    return 100.0 if not total else (1 - (total - 2 * subsequence(left, right)) / total) * 100


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=300), st.text("abc", max_size=300), st.sampled_from([0.0, 60.0, 90.0]))
def test_similarity(left, right, threshold):
    expected = ratio(left, right)
    assert dedup.similarity(left, right, threshold) == (expected if expected >= threshold else 0.0)


def test_only_the_band_is_computed(monkeypatch):
    rnd = random.Random(4)
    left = "".join(rnd.choice("abcd ") for _ in range(6000))
    right = "".join(c for c in left if rnd.random() > 0.02)
    widths, check = [], dedup._least_edits
    monkeypatch.setattr(dedup, "_least_edits", lambda row, *rest: widths.append(row.bit_length()) or check(row, *rest))
    assert dedup.common_subsequence(left, right, 200) == len(right)
    assert widths and max(widths) < 200 + 2 * dedup._CHECK_EVERY + 10
    other = "".join(rnd.choice("abcd ") for _ in range(6000))
    assert dedup.common_subsequence(left, other, 600) is None and dedup.common_subsequence(left, left[:5000], 999) is None


def near_copies(count, seed):
    random.seed(seed)
    texts = []
    for _ in range(count):
        if texts and random.random() < 0.5:
            text = list(random.choice(texts[-12:]))
            for _ in range(random.randint(0, 8)):
                place = random.randrange(len(text) + 1)
                text[place : place + random.randint(0, 1)] = random.choice(["", "x", "é"])
            texts.append("".join(text))
        else:
            texts.append("".join(random.choices("abcdefgh \n", k=random.randint(0, 90))))
    return texts


@pytest.mark.parametrize("window, threshold, block", [(49, 90.0, 512), (5, 80.0, 7), (10, 95.0, 16)])
def test_fuzzy_pairs_match_brute_force(spark, monkeypatch, window, threshold, block):
    monkeypatch.setattr(dedup, "PAIR_BLOCK", block)
    texts = near_copies(120, seed=window)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(5)
    got = dedup.fuzzy_pairs(dedup.with_position(rows, ["i"]), threshold=threshold, window=window).collect()
    expected = {
        (i, j): round(ratio(texts[i], texts[j]), 2)
        for i in range(len(texts))
        for j in range(i + 1, min(i + window + 1, len(texts)))
        if texts[i].strip() and texts[j].strip() and ratio(texts[i], texts[j]) >= threshold
    }
    assert len(got) == len(expected) > 0
    assert {(row.pos_1, row.pos_2): row.similarity for row in got} == expected


def test_later_rows_go_even_when_the_earlier_one_does(spark):
    texts = ["sail the boat home tonight.", "sail the boat home tonight!", "sail the boat home tonight?", "something else"]
    rows = dedup.with_position(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), ["i"])
    left = dedup.drop_fuzzy_duplicates(rows, dedup.fuzzy_pairs(rows))
    assert sorted(row.i for row in left.collect()) == [0, 3]


def test_positions(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(9)
    got = dedup.with_position(rows, ["k"]).collect()
    assert len(got) == 1000 and all(row.k == row.pos for row in got)


def test_keep_first_is_idempotent_and_limits_before_the_shuffle(spark):
    rows = spark.createDataFrame([(i, f" Text\t{i % 3} " if i % 2 else f"text {i % 3}") for i in range(60)], "i int, text string")
    once = dedup.keep_first(rows.repartition(4), dedup_key(F.col("text")), ["i"])
    assert sorted(row.i for row in once.collect()) == [0, 1, 2]
    assert dedup.keep_first(once, dedup_key(F.col("text")), ["i"]).count() == 3
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("WindowGroupLimit") :]


def test_candidate_pairs(spark):
    lengths = [random.Random(1).randint(1, 40) for _ in range(130)]
    rows = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(lengths)], "pos bigint, text string")
    got = {(row.pos_1, row.pos_2) for row in dedup.candidate_pairs(rows, window=49).collect()}
    assert got == {
        (i, j) for i in range(130) for j in range(i + 1, min(i + 50, 130))
        if 200 * min(lengths[i], lengths[j]) / (lengths[i] + lengths[j]) >= 90
    }
