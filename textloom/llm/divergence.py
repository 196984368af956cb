"""Source divergence audit: how far each source's words are from those of its peers and of its language.

Counts become smoothed integer shares of a billion, and the distance of two shares is a chi-square
term, all in whole numbers. The comparison of all sources of a language is a sparse product by rows
(Gustavson): the term-major index lies spread over the tasks, a posting list per term; for each
source's postings a task walks the lists of the same terms and scatters what it finds into a dense
row with a cell per peer. No pair of postings leaves a task, only the cells, once per task. A term
that one side lacks still counts, with that side's share of a zero count. That baseline is the same
for all such terms, so it is added in closed form: once per distinct count for terms that one side
has, and once for the whole vocabulary for the rest; lists' walks correct it where both have a term.

Counting is combined in each task before the one shuffle, by language and term; a source or a term
that holds a third of all rows is so many summed rows, no more than tasks or sources there are.

Defined results: null texts, languages and sources count as empty ones; texts without terms still
make their group occur; a language without kept terms has a distance of zero between all its
sources; ties go to the smaller name; repeated rows count as often as they come; an empty table
gives no rows; texts of any length are counted whole; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm import worker
from textloom.plans.session import staged

#: Documents of its language that a term needs, the unit that shares are counted in, ranks of terms.
LEAST_DOCUMENTS, UNIT, TOP = 3, 1_000_000_000, 200
#: Most groups of a language and a source whose totals are sent to all tasks, 16 bytes each. More are
#: refused: the result has a row per pair of a language's groups, so it would outgrow them by far.
MOST_GROUPS = 1 << 20
#: Terms a counting task remembers, postings taken at once, cells and pairs worked on at once.
_TERMS, _POSTINGS, _CELLS = 300_000, 1 << 19, 1 << 20
_FOLD = bytes(x + 32 if 0x41 <= x <= 0x5A else x if 0x61 <= x <= 0x7A or x >= 0x80 else 0x20 for x in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of letters A-Z, lower-cased, and of characters beyond ASCII."""
    return text.translate(_FOLD).split()


class _Counts:
    """Occurrences and documents by group and term, gathered over the texts of a task."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.rows = 0

    def add(self, names: list[tuple[str, str]], rows: list[list[bytes]]) -> None:
        group = np.array([self.groups.setdefault(x, len(self.groups)) for x in names], dtype=np.int64)
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        if not size.sum():
            return
        for word in {*chain.from_iterable(rows)}:
            self.codes.setdefault(word, len(self.codes))
        code = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(rows)), np.int64, int(size.sum()))
        own, count = np.unique((np.repeat(np.arange(len(rows)), size) << 32) | code, return_counts=True)
        own = (group[own >> 32] << 32) | (own & 0xFFFFFFFF)
        self.parts.append(_summed(np.stack([own, count, np.ones(len(own), dtype=np.int64)])))
        self.rows += self.parts[-1].shape[1]
        if self.rows > 4 * _TERMS and len(self.parts) > 1:
            self.parts = [_summed(np.concatenate(self.parts, axis=1))]
            self.rows = self.parts[0].shape[1]

    def full(self) -> bool:
        return len(self.codes) > _TERMS or self.rows > 4 * _TERMS

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            key, count, docs = _summed(np.concatenate(self.parts, axis=1))
            names = [pa.array([x[i] for x in self.groups], pa.string()) for i in (0, 1)]
            words = pa.array(list(self.codes), pa.binary())
            for low in range(0, len(key), 1 << 16):
                at = slice(low, low + (1 << 16))
                of = [names[i].take(pa.array(key[at] >> 32)) for i in (0, 1)]
                term = words.take(pa.array(key[at] & 0xFFFFFFFF)).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*of, term, pa.array(count[at]), pa.array(docs[at])], names=["lang", "source", "term", "n", "docs"]
                )
        self.clear()


def _summed(table: np.ndarray) -> np.ndarray:
    """Rows of equal key (the first line of the table) added up, by key."""
    table = table[:, np.argsort(table[0], kind="stable")]
    starts = np.flatnonzero(np.concatenate([[True], table[0, 1:] != table[0, :-1]]))
    return np.stack([table[0, starts], *(np.add.reduceat(line, starts) for line in table[1:])])


def _named(df: DataFrame, lang: str, source: str, *also) -> DataFrame:
    names = [F.coalesce(F.col(c), F.lit("")).alias(to) for c, to in ((lang, "lang"), (source, "source"))]
    return df.select(*names, *also)


def groups(df: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Every language and source that occur together, with ``g``, the source's place among its language's."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return _named(df, lang, source).distinct().select("lang", "source", place.alias("g"))


def kept_terms(df: DataFrame, named: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """The term-major index: a row per language and kept term with ``total`` and the lists ``gs``, ``counts``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts()
        for batch in worker.slices(batches, "text"):
            names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            held.add(names, [terms(t) for t in worker.texts(batch, "text")])
            if held.full():
                yield from held.batches()
        yield from held.batches()

    counted = _named(df, lang, source, F.col(text).alias("text")).mapInArrow(count, "lang string, source string, term string, n long, docs long")
    # Both sums need a language's term in one place, so one shuffle serves them.
    by_group = counted.repartition("lang", "term").join(named, ["lang", "source"]).groupBy("lang", "term", "g").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_group.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("g", "n"))).alias("held")
    )
    return by_term.where(F.col("docs") >= least).select("lang", "term", "total", F.col("held.g").alias("gs"), F.col("held.n").alias("counts"))


def shares(count: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / size), exactly, digit by digit so that nothing overflows."""
    whole, rest = np.divmod(count + 1, size)
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // size, rest % size
    return 1 + whole


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q). Shares above one add up to ``UNIT`` at most in a group, so that sums of
    these over any terms stay below 2^62."""
    return (p - q) * (p - q) // q


class _Rows:
    """The accumulators of one language in one task: a dense row with a cell per peer for each group."""

    def __init__(self, sizes: np.ndarray, vocabulary: int, total: int):
        self.size, self.vocabulary, self.whole = sizes + vocabulary, vocabulary, total + vocabulary
        self.base = shares(np.zeros(len(sizes), dtype=np.int64), self.size)
        self.cells = None

    def slices(self, term: np.ndarray, g: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """First group and rows of blocks of groups after the postings (sorted by term) are scattered."""
        p = shares(n, self.size[g])
        many = len(self.base)
        height = max(1, 4 * _CELLS // many)
        for low in range(0, many, height):
            high = min(many, low + height)
            if high - low == many and self.cells is not None:
                cells = self.cells
            else:
                cells = np.zeros((high - low, many), dtype=np.int64)
            self._one_sided(cells, low, high, g, n)
            self._both_sided(cells, low, high, term, g, p)
            if high - low == many:
                self.cells = cells
            else:
                yield low, cells

    def _one_sided(self, cells: np.ndarray, low: int, high: int, g: np.ndarray, n: np.ndarray) -> None:
        """What a group's own terms add as if no peer had them, and a peer's as if the group lacked them."""
        order = np.lexsort((n, g))
        of, n = g[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (n[1:] != n[:-1])]))
        times = np.diff(np.concatenate([new, [len(n)]]))
        of, base = of[new], self.base
        p = shares(n[new], self.size[of])
        step = max(1, _CELLS // len(base))
        for first in range(0, len(of), step):
            at = slice(first, first + step)
            own = (of[at] >= low) & (of[at] < high)
            mine, q, k = of[at][own], p[at][own, None], times[at][own, None]
            np.add.at(cells, mine - low, k * (distance(q, base[None, :]) - distance(base[mine, None], base[None, :])))
            theirs, q, k = of[at], p[at][:, None], times[at][:, None]
            add = k * (distance(base[None, low:high], q) - distance(base[None, low:high], base[theirs, None]))
            np.add.at(cells.T, theirs, add)

    def _both_sided(self, cells: np.ndarray, low: int, high: int, term: np.ndarray, g: np.ndarray, p: np.ndarray) -> None:
        """Walk, for each posting of a group, the list of its term, and correct the cells of the peers in it."""
        starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        size = np.diff(np.concatenate([starts, [len(term)]]))
        listed = np.repeat(np.arange(len(starts)), size)
        rows = np.flatnonzero((g >= low) & (g < high))
        rows = rows[np.argsort(g[rows], kind="stable")]
        many = size[listed[rows]]
        ends, flat, base = np.cumsum(many), cells.reshape(-1), self.base
        done = 0
        while done < len(rows):
            upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + _CELLS, side="right")))
            k, x = many[done:upto], rows[done:upto]
            before = np.cumsum(k) - k
            y = np.repeat(starts[listed[x]] - before, k) + np.arange(int(k.sum()))
            x = np.repeat(x, k)
            px, py, bx, by = p[x], p[y], base[g[x]], base[g[y]]
            both = distance(px, py) - distance(px, by) - distance(bx, py) + distance(bx, by)
            np.add.at(flat, (g[x] - low) * cells.shape[1] + g[y], both)
            done = upto


def _best(g: np.ndarray, value: np.ndarray, at: np.ndarray, words: list[bytes], top: int) -> np.ndarray:
    """Places of the ``top`` largest values of each group; ties go to the smaller word."""
    order = np.lexsort((-value, g))
    g, value, at = g[order], value[order], at[order]
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else []
    found = []
    for low, high in zip(starts, [*starts[1:], len(g)]):
        if high - low > top:
            last = value[low + top - 1]
            sure = low + int(np.searchsorted(-value[low:high], -last, side="left"))
            tied = low + int(np.searchsorted(-value[low:high], -last, side="right"))
            least = sorted(range(sure, tied), key=lambda i: words[at[i]])[: low + top - sure]
            found += [*range(low, sure), *least]
        else:
            found += range(low, high)
    return order[np.array(found, dtype=np.int64)]


def _scatter(totals: dict[str, tuple[np.ndarray, int, int]], top: int):
    """A task over rows of the term-major index."""

    def emit(lang: str, g, peer, term, value) -> pa.RecordBatch:
        peers = pa.nulls(len(g), pa.int32()) if peer is None else pa.array(peer, pa.int32())
        words = pa.nulls(len(g), pa.string()) if term is None else pa.array(term, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(g), pa.string()), pa.array(g, pa.int32()), peers, words, pa.array(value, pa.int64())],
            names=["lang", "g", "peer", "term", "value"],
        )

    def cells(lang: str, low: int, block: np.ndarray) -> Iterator[pa.RecordBatch]:
        for first in range(0, block.size, 1 << 16):
            at = first + np.flatnonzero(block.reshape(-1)[first : first + (1 << 16)])
            if len(at):
                yield emit(lang, low + at // block.shape[1], at % block.shape[1], None, block.reshape(-1)[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Rows] = {}
        for table in _gathered(batches):
            langs = table.column("lang").to_numpy(zero_copy_only=False)
            for lang in dict.fromkeys(langs):
                part = table.filter(pa.array(langs == lang)).combine_chunks()
                words = part.column("term").cast(pa.binary()).to_pylist()
                lists = part.column("gs").combine_chunks()
                size = lists.value_lengths().to_numpy(zero_copy_only=False)
                g = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                n = part.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
                term = np.repeat(np.arange(len(size)), size)
                if lang not in held:
                    held[lang] = _Rows(*totals[lang])
                rows = held[lang]
                for low, block in rows.slices(term, g, n):
                    yield from cells(lang, low, block)
                p = shares(n, rows.size[g])
                q = shares(part.column("total").to_numpy(), rows.whole)[term]
                over = np.flatnonzero(p > q)
                value = distance(p[over], q[over])
                best = _best(g[over], value, term[over], words, top)
                yield emit(lang, g[over][best], None, [words[i] for i in term[over][best]], value[best])
        for lang, rows in held.items():
            if rows.cells is not None:
                yield from cells(lang, 0, rows.cells)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in tables of about ``_POSTINGS`` postings."""
    kept, many = [], 0
    for batch in batches:
        size = batch.column("gs").value_lengths().to_numpy(zero_copy_only=False)
        for low in range(0, batch.num_rows, 1024):
            kept.append(batch.slice(low, 1024))
            many += int(size[low : low + 1024].sum())
            if many > _POSTINGS:
                yield pa.Table.from_batches(kept)
                kept, many = [], 0
    if kept:
        yield pa.Table.from_batches(kept)


def audit(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP, most_groups: int = MOST_GROUPS,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: for each group its peers (part ``pair``), the
    farthest first, and its ``top`` terms (part ``term``) that stand out most against the language."""
    named = staged(groups(df, lang, source), "groups")
    index = staged(kept_terms(df, named, text, lang, source, least), "terms")
    own = index.select("lang", F.explode(F.arrays_zip("gs", "counts")).alias("x")).groupBy("lang", F.col("x.gs").alias("g")).agg(F.sum("x.counts").alias("n"))
    of_lang = index.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("all"))
    sized = named.join(own, ["lang", "g"], "left").join(of_lang, "lang", "left").na.fill(0, ["n", "v", "all"])
    sized = staged(sized, "sizes")
    if sized.count() > most_groups:
        raise ValueError(f"more than {most_groups} groups of a language and a source")
    # At most most_groups rows of numbers.
    table = sized.where("v > 0").select("lang", "g", "n", "v", "all").orderBy("lang", "g").toArrow()
    langs = table.column("lang").to_numpy(zero_copy_only=False)
    n, v, whole = (table.column(c).to_numpy() for c in ("n", "v", "all"))
    totals = {x: (n[langs == x], int(v[langs == x][0]), int(whole[langs == x][0])) for x in dict.fromkeys(langs)}
    found = staged(index.mapInArrow(_scatter(totals, top), "lang string, g int, peer int, term string, value long"), "divergence")

    base = f"(1 + {UNIT} div ({{0}} + v))"
    peers = sized.select("lang", F.col("g").alias("peer"), F.col("source").alias("item"), F.col("n").alias("m"))
    p, q = base.format("n"), base.format("m")
    zero = F.expr(f"IF(v = 0, 0L, v * ((({p}) - ({q})) * (({p}) - ({q})) div ({q})))")
    summed = found.where("peer IS NOT NULL").groupBy("lang", "g", "peer").agg(F.sum("value").alias("more"))
    pairs = sized.join(peers, "lang").where("g <> peer").join(summed, ["lang", "g", "peer"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", (zero + F.coalesce("more", F.lit(0))).alias("value")
    )
    singled = found.where("peer IS NULL").join(named, ["lang", "g"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = singled.withColumn("rank", place).where(F.col("rank") <= top)
    return pairs.withColumn("rank", place).unionByName(ranked)
