"""The prefix trie against nodes counted one by one."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from textloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, name long, piece string, depth int, conv string"


def _plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x)] for c, x in turns.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    again = {c: own.get(c - int(math.fmod(c, 100)), [])[: h[c]] + s[h[c] :] for c, s in own.items()}
    members, below, totals, found = defaultdict(list), defaultdict(list), {}, []
    for c, s in again.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(totals[x][0] for x in below[node]) if below[node] else 1
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(totals[x][1] for x in below[node])
        totals[node] = leaves, saved
        ends = ",".join(str(c) for c in sorted(members[node]) if len(again[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        found.append((min(members[node]), len(node), up, len(members[node]), len(below[node]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def _rows(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    rows = []
    for conv in [*range(30), *range(95, 125), *range(200, 220), -5, -100, -130, 10**12, 10**12 + 70]:
        long = rnd.choice([1, 7, 8, 9, 16, 17, 33, 65]) if conv % 7 == 0 else rnd.randint(1, 6)
        for turn in range(long):
            role = rnd.choice(["user", "bot", None]) if turn % 3 == 0 else "user"
            rows.append((conv, rnd.choice([turn, turn, None]), role, rnd.choice(["x", "yé\U0001f600", None]) if rnd.random() < 0.15 else "same" * (turn % 3)))
    rows += [(None, 1, "user", "lost"), (4, None, None, None), (4, None, None, None), (301, 1, "user", "z" * 100_000)]
    return rows + [(conv, turn, "user", f"deep {turn}") for conv in (400, 401, 402) for turn in range(150)]


@pytest.mark.parametrize("seed, slot, hot", [(1, 4096, 1000), (2, 3, 1), (3, 2, 10**9)])
def test_trie_equals_plain_counting(spark, monkeypatch, seed, slot, hot):
    monkeypatch.setattr(prefix_trie, "_SLOT", slot)
    monkeypatch.setattr(prefix_trie, "_HOT", hot)
    rows = _rows(seed)
    df = spark.createDataFrame([(*r, 1, "p", 2, "c") for r in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in prefix_trie.trie(df).collect()), key=str) == _plain(rows)


def test_trie_of_short_and_of_no_conversations(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    # h is at least the turns there are and the first of the hundred is absent: all turns go.
    gone = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(gone, 1, "user", "one")]
    got = [tuple(r) for r in prefix_trie.trie(spark.createDataFrame([(*r, 1, "p", 2, "c") for r in rows], SCHEMA)).collect()]
    assert got == _plain(rows) and got[0][1] == 0 and got[0][5] == 1


def test_a_conversation_goes_on_from_task_to_task():
    """Places are numbered within a task; batches may end within a conversation."""
    import numpy as np
    import pyarrow as pa

    from unittest import mock

    def batch(ids):
        n = len(ids)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([b"t"] * n), pa.array([1] * n, pa.int32())], names=["conv", "turn", "chars"])

    with mock.patch.object(prefix_trie, "TaskContext") as context:
        context.get.return_value.partitionId.return_value = 5
        out = [*prefix_trie._number(iter([batch([1, 1, 2]), batch([]), batch([2, 2]), batch([2, 3])]))]
    assert np.concatenate([b.column("place").to_numpy() for b in out]).tolist() == [0, 1, 0, 1, 2, 3, 0]
