"""The source divergence audit against plain whole-number arithmetic."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from textloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, g int, n long, peer string"


def _plain(rows, top):
    docs = [(lang or "", source or "", [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    found = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(w for d in own for w in {*d[2]})
        kept = {w for w, c in seen.items() if c >= 3}
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, words in own:
            counts[s].update(w for w in words if w in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c, w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))
        apart = lambda p, q: (p - q) ** 2 // q
        for s, mine in counts.items():
            pairs = [(o, sum(apart(share(mine, w), share(theirs, w)) for w in kept)) for o, theirs in counts.items() if o != s]
            terms = [(w, apart(share(mine, w), share(whole, w))) for w in mine if share(mine, w) > share(whole, w)]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, s, part, *x, i) for i, x in enumerate(items, 1) if part == "pair" or i <= top]
    return sorted(found)


def _rows(seed: int) -> list[tuple]:
    rnd = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in "abcÉñ日" for b in ["lo", "Ra", "mi"]] + ["x"]
    rows = [(" 1,".join(rnd.choice(words, rnd.integers(0, 40))), rnd.choice(["en", "de"]), f"s{rnd.integers(0, 6)}") for _ in range(120)]
    rows += [rows[0]] * 60 + [(None, None, None), ("", "en", "quiet"), (None, "xx", "a"), ("only here", "xx", "b"), ("alo " * 20_000, "en", None)]
    return [(t, lang and str(lang), s and str(s)) for t, lang, s in rows]


@pytest.mark.parametrize("seed, top, cells", [(1, 200, 1 << 20), (2, 3, 1 << 20), (3, 5, 1)])
def test_audit_equals_plain_arithmetic(spark, monkeypatch, seed, top, cells):
    """Small limits make every flush, slice, block of groups and cut of ties happen."""
    rows = _rows(seed)
    if cells == 1:
        monkeypatch.setattr(divergence, "_CELLS", cells)
        monkeypatch.setattr(divergence, "_POSTINGS", 3)
        monkeypatch.setattr(divergence, "_TERMS", 5)
    df = spark.createDataFrame([(1, *r, 1, 1, "p") for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in divergence.audit(df, top=top).collect()]
    assert sorted(got) == _plain(rows, top)


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert divergence.audit(empty).count() == 0
    lone = spark.createDataFrame([(1, "some words", "en", "s", 1, 1, "p")], SCHEMA)
    assert divergence.audit(lone).count() == 0
    with pytest.raises(ValueError, match="more than 0 groups"):
        divergence.audit(lone, most_groups=0)


def test_shares_and_distances_do_not_overflow():
    count, size = np.array([0, 10**12, 10**15 - 1, 10**15]), np.array([3, 3 * 10**12, 10**15, 10**15 + 7])
    assert divergence.shares(count, size).tolist() == [1 + 10**9 * (c + 1) // s for c, s in zip(count.tolist(), size.tolist())]
    assert divergence.distance(np.array([10**9 + 1]), np.array([1])).tolist() == [10**18]
