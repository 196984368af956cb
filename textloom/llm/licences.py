"""License scans: normalised text against license templates by Dice coefficient over word bigrams.

Every line of a text and the whole text are normalised to lower-case ASCII words and compared, as
sets of bigrams, with the templates. A Dice coefficient of ``LIMIT`` or more needs sizes within a
factor of ``(2 - LIMIT) / LIMIT`` of each other; templates outside that bound are not compared, and
of the others only those that share a bigram. Templates are a parameter and as few as licenses are,
so every task holds them.

Defined results: null, empty and one-word texts have no bigrams and match nothing; of templates with
equal scores the first by name wins a line; a text of any length is read whole; repeated rows are
scanned each; an empty table, or no templates, gives no matches; other columns are neither read nor
returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import worker

LIMIT = 0.8
_WORDS = re.compile(rb"[a-z0-9]+")

# Short license notices by SPDX name, and one full text.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
}


def bigrams(text: bytes) -> set[tuple[bytes, bytes]]:
    words = _WORDS.findall(text.lower())
    return {*zip(words, words[1:])}


class Scanner:
    """Templates by bigram and size."""

    def __init__(self, templates: Mapping[str, str], limit: float):
        self.limit = limit
        self.sets = {name: bigrams(text.encode()) for name, text in sorted(templates.items())}
        self.having: dict[tuple[bytes, bytes], list[str]] = {}
        for name, own in self.sets.items():
            for pair in own:
                self.having.setdefault(pair, []).append(name)
        sizes = [len(own) for own in self.sets.values() if own] or [1]
        self.least, self.most = min(sizes) * limit / (2 - limit), max(sizes) * (2 - limit) / limit
        # A line without any of these words shares no bigram with a template.
        firsts = sorted({pair[0] for pair in self.having})
        self.word = re.compile(rb"\b(?:" + b"|".join(map(re.escape, firsts)) + rb")\b") if firsts else None

    def best(self, text: bytes) -> tuple[str, float] | None:
        """The template with the highest coefficient, if it reaches the limit."""
        own = bigrams(text)
        if not self.least <= len(own) <= self.most:
            return None
        shared: dict[str, int] = {}
        for pair in own:
            for name in self.having.get(pair, ()):
                shared[name] = shared.get(name, 0) + 1
        fits = [n for n in shared if len(own) * self.limit <= len(self.sets[n]) * (2 - self.limit) and len(self.sets[n]) * self.limit <= len(own) * (2 - self.limit)]
        scored = [(-2 * shared[n] / (len(own) + len(self.sets[n])), n) for n in fits]
        score, name = min(scored, default=(0.0, ""))
        return (name, -score) if -score >= self.limit else None

    def scan(self, text: bytes) -> list[tuple[int, str, float]]:
        """Line number from 1 (0: the whole text), template and coefficient of each match."""
        if self.word is None:
            return []
        lines = text.split(b"\n")
        parts = [(i, line) for i, line in enumerate(lines, 1) if self.word.search(line.lower())]
        found = [(i, self.best(part)) for i, part in ([(0, text)] if len(lines) > 1 else []) + parts]
        return [(i, *hit) for i, hit in found if hit]


def scan(df: DataFrame, templates: Mapping[str, str] = TEMPLATES, limit: float = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per match: ``key``, ``line`` (from 1; 0 is the whole text), ``license`` and ``dice``."""
    name = df.schema[key].dataType.simpleString()
    templates = dict(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, limit)
        for batch in worker.slices(batches, "text"):
            found = [(i, *hit) for i, t in enumerate(worker.texts(batch, "text")) for hit in scanner.scan(t)]
            if found:
                rows, lines, names, dice = zip(*found)
                columns = [batch.column("key").take(pa.array(rows)), pa.array(lines, pa.int32()), pa.array(names), pa.array(dice, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "line", "license", "dice"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {name}, line int, license string, dice double").withColumnRenamed("key", key)
