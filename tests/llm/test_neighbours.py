"""Nearest neighbours against brute force: recall, exact scores, ties and hard vectors."""

from __future__ import annotations

import numpy as np
import pytest

from textloom.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, id string, list int, tile long"
EACH = "id % 20 = 0"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], SCHEMA).repartition(4)


def _usable(rows, n):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == n and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i, tuple(np.float32(v).tolist())] = None
    return [(i, np.array(v)) for i, v in good]


def _plain(rows, n, k=20):
    good = _usable(rows, n)
    found = {}
    for i in sorted({i for i, _ in good if i % 20 == 0}):
        q = np.array(min(tuple(v) for j, v in good if j == i))
        best = sorted((-sum(a * b for a, b in zip(q.tolist(), v.tolist())), j) for j, v in good if j != i)[:k]
        found[i] = [(j, -s) for s, j in best]
    return found


def _got(frame, **also):
    found = {}
    for r in sorted(neighbours.search(frame, EACH, **also).collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


@pytest.mark.parametrize("tile, block, lists", [(8192, 2048, 4096), (40, 3, 7)])
def test_all_lists_probed_is_exact(spark, monkeypatch, tile, block, lists):
    """With every list probed only the tests on columns could lose a row; small limits cut lists and blocks."""
    monkeypatch.setattr(neighbours, "TILE", tile)
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rnd = np.random.default_rng(tile)
    rows = [(i, (rnd.standard_normal(12) * rnd.choice([0.1, 1, 30])).tolist()) for i in range(300)]
    same = (100 * rnd.standard_normal(12)).tolist()
    rows += [(1000 + i, same) for i in range(60)] + [rows[0], rows[0], (40, same), (None, same), (2000, None), (2001, [0.0] * 12), (2020, [1.0, None] + [1.0] * 10)]
    rows += [(2002, [float("nan")] * 12), (2003, [float("inf")] + [0.0] * 11), (2040, [1.0, 2.0]), (2004, [])]
    got, want = _got(_frame(spark, rows), target=1.0, most_lists=lists), _plain(rows, 12)
    assert got.keys() == want.keys()
    right = sum(a == b for q in want for (a, _), (b, _) in zip(got[q], want[q], strict=True))
    assert right >= 0.99 * sum(map(len, want.values()))
    scores = {(i, tuple(v.tolist())): v for i, v in _usable(rows, 12)}
    for q, best in got.items():
        mine = np.array(min(v for i, v in scores if i == q))
        theirs = {i: [sum(a * b for a, b in zip(mine.tolist(), v)) for j, v in scores if j == i] for i, _ in best}
        assert all(any(s == pytest.approx(x, rel=1e-12) for x in theirs[i]) for i, s in best)
    # Copies tie: the smaller ids come first.
    ties = [i for i, _ in got[1000]]
    assert ties == [40, *range(1001, 1020)]


def test_recall_on_given_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    got = _got(frame)
    hits = []
    for i in ids[ids % 20 == 0].tolist():
        score = x @ x[ids == i][0]
        score[ids == i] = -np.inf
        hits.append(len({*ids[np.argsort(-score)[:20]].tolist()} & {j for j, _ in got[i]}) / 20)
        assert len(got[i]) == 20
    assert np.mean(hits) >= 0.93


def test_few_rows_and_none(spark):
    assert neighbours.search(_frame(spark, []), EACH).count() == 0
    assert neighbours.search(_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), EACH).count() == 0
    assert neighbours.search(_frame(spark, [(20, [1.0, 2.0])]), EACH).count() == 0
    assert _got(_frame(spark, [(0, [1.0, 0.0]), (1, [2.0, 1.0]), (7, [-1.0, 0.0])])) == {0: [(1, 2.0), (7, -1.0)]}


def test_tests_on_columns_rarely_abandon_a_near_row():
    """The beta bound holds for random pairs, and the scan loses next to none of the true neighbours."""
    rnd = np.random.default_rng(4)
    x = rnd.standard_normal((4000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tile = neighbours._Tile(np.arange(4000), x, np.zeros(4000, np.int64), 1.0)
    i, j, score = tile.nearest(np.arange(100), x[:100], np.full(100, np.inf), np.ones((100, 1), bool), 20)
    exact = x[:100] @ x.T
    np.fill_diagonal(exact, -np.inf)
    true = np.argsort(-exact, axis=1)[:, :20]
    assert sum(len({*j[i == q].tolist()} & {*true[q].tolist()}) for q in range(100)) >= 0.99 * 2000
    # A limit as the neighbours give it leaves the tests much to abandon.
    near = 2 - 2 * np.sort(exact, axis=1)[:, -20]
    alive, _, _ = tile.scan(neighbours._unlifted(x[:100], 1.0).astype(np.float32) @ tile.turn, 0, 4000, near.astype(np.float32))
    assert len(alive) <= 100 * 25
    assert abs(neighbours.beta_quantile(0.5, 16, 16) - 0.5) < 1e-3 and neighbours.beta_quantile(0.999, 8, 24) > 0.45
