"""Memory of single tasks on dense inputs, the learner against a scalar one, columns with clashing names."""

from __future__ import annotations

import math
import random
import tracemalloc

import numpy as np

import corpus_pipeline
from textloom.llm import pii, simhash, toxicity, worker

SF = "/root/testdata/sf0.001"


def _peak(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_dense_block_costs_a_slice_of_its_pairs():
    rnd = np.random.default_rng(1)
    fp = np.unique(np.array([sum(1 << int(b) for b in rnd.choice(64, 2, replace=False)) for _ in range(4096)], dtype=np.uint64))
    fp = np.concatenate([fp, fp])
    home = np.arange(len(fp)) < len(fp) // 2
    found = []
    assert _peak(lambda: found.append(simhash._forest(np.ones(len(fp), np.int64), fp, home, 3))) < 60
    a, b = found[0]
    reached, edges = {int(a.min())}, list(zip(a.tolist(), b.tolist()))
    while grown := {y for x, y in edges if x in reached} | {x for x, y in edges if y in reached} - reached:
        if grown <= reached:
            break
        reached |= grown
    # All pairs of two-bit words that share a bit are three bits apart at most.
    assert reached == {*fp.tolist()} and len(edges) == len(reached) - 1


def test_joining_labels_equals_one_by_one():
    rnd = random.Random(2)
    label, parent = np.arange(200), list(range(200))
    for _ in range(6):
        pairs = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(20)]
        label = simhash._united(label, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
        for a, b in pairs:
            low, high = sorted((parent[a], parent[b]))
            parent = [low if p == high else p for p in parent]
        assert label.tolist() == parent


def test_proposals_of_texts_full_of_numbers_stay_small():
    text = " ".join(f"({100 + i % 900}) 555-{1000 + i % 9000}" for i in range(100_000))

    def work():
        held = pii._Proposals()
        held.add(text)
        held.columns()

    assert _peak(work) < 300 * len(text) / 2e6


def test_proposals_keep_their_documents():
    texts = ["mail a.b@c.org", "", "call +1 555 123 4567 or 555-123-4567, card 4111 1111 1111 1111", "none", "x@y z at 10.0.0.1"]
    held = pii._Proposals()
    for text in texts:
        held.add(text)
    base, proposed = (x.to_pylist() for x in held.columns())
    for text, own, all_ in zip(texts, base, proposed):
        assert [tuple(s.values()) for s in own] == pii.base_spans(text)
        assert [tuple(s.values()) for s in all_] == [(*s[:5], s[5]) for s in pii.proposed_spans(text, pii.base_spans(text))]


def _scalar(rows, labels, s):
    seen = {}
    for row in rows:
        for f in row:
            seen[f] = seen.get(f, 0) + 1
    z, n = {}, {}
    bias = toxicity.SPACE

    def weight(f):
        l1 = s.l1 * math.sqrt(seen[f]) if f != bias else 0.0
        zf = z.get(f, 0.0)
        return 0.0 if abs(zf) <= l1 else -math.copysign(abs(zf) - l1, zf) / ((s.beta + math.sqrt(n.get(f, 0.0))) / s.alpha + s.l2)

    for _ in range(s.passes):
        for row, label in zip(rows, labels):
            own = [f for f in row if seen[f] >= s.least_rows] + [bias]
            w = {f: weight(f) for f in own}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
            for f in own:
                before = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / s.alpha * w[f]
                n[f] = before + g * g
    return {f: weight(f) for f in z if weight(f) or f == bias}


def test_learner_equals_a_scalar_one():
    rnd = np.random.default_rng(3)
    rows = [np.unique(rnd.integers(0, 60, 12)) * 65_537 for _ in range(150)]
    labels = np.array([float(60 * 65_537 // 3 > r[0] and len(r) % 2) for r in rows])
    model = toxicity.ftrl(list(rows), labels, toxicity.Settings())
    want = _scalar([r.tolist() for r in rows], labels.tolist(), toxicity.Settings())
    got = dict(zip(model.at.tolist(), model.weight.tolist()))
    assert got.keys() == want.keys() and all(math.isclose(got[f], want[f], rel_tol=1e-9, abs_tol=1e-12) for f in want)


def test_learner_keeps_nothing_for_coordinates_it_does_not_use():
    rows = [np.arange(40) * 1000 for _ in range(50)]
    assert _peak(lambda: toxicity.ftrl(rows, np.arange(50) % 2.0, toxicity.Settings())) < 60


def test_own_names_meet_no_column(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    clash = {"_key": "k", "_digest": "d", "_spans": "s", "_own_key": "k", "_OWN_DIGEST": "d", "_own_spans": "s", "spans": "s", "root": "r", "component": "c", "digest": "d", "base": "b"}
    texts = ["alpha beside quiet rivers", "alpha beside quiet rivers", "mail x@mail.example.com now", item, None]
    rows = [(i, t, None, "s", 1, *clash.values()) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in clash))
    assert worker.unused(docs, "key", "digest", "new") == ["__own_key", "__own_digest", "_own_new"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns
        kept[name] = {r.doc_id: r for r in found.collect()}
        assert all([*r][5:] == [*clash.values()] for r in kept[name].values())
    assert {*kept["near_duplicates"]} == {0, 2, 3, 4} and {*kept["decontamination"]} == {0, 1, 2, 4}
    assert kept["personal_data"][2].text == "mail [email] now" and len(kept["personal_data"]) == 5
