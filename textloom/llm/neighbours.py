"""Nearest neighbours by inner product: inverted lists, scanned a few columns at a time.

Vectors are scaled into the unit ball and get one more coordinate that puts them on its surface, so
that the largest inner product is the smallest distance. An index of lists around centroids is fitted
on a bounded sample; every row is put into a list. How many lists a query probes is not guessed: it is
the least number that reaches ``target`` recall for ``_TRIAL`` queries, whose true neighbours among
all rows are found by brute force in one pass.

Within a probed list distances are summed up block by block of randomly rotated columns. After a random
rotation the share of a squared distance that lies in the first d of D columns is beta-distributed, so
a candidate whose partial sum could belong to a distance within the query's limit only with probability
``_RISK`` is abandoned. The limit is that of the best rows seen so far, at first that of the sample.
Rows that are left are scored exactly, in double precision on the vectors as given.

Rows lie in tiles of about ``TILE`` rows: whole lists side by side, or pieces of a long list. Queries of
neighbouring tiles make a block; a tile meets a block only if one of its queries probes it, in a group
of bounded size. Equal vectors in a tile have equal scores, so those of the smallest ids stand for all.

Defined results: vectors that are null, zero or hold null or non-finite components take no part, nor do
those of another length than the most frequent (the longest of these), nor rows without an id; rows
equal in id and vector count once; rows that share an id but not the vector are candidates each, and
never of a query of their id, whose vector is the smallest of theirs; ties go to the smaller id; fewer
candidates than asked for are all returned; no queries or no rows give no rows; other columns are
neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm import worker
from textloom.plans.session import small_side, staged

#: Rows of a tile and queries of a block; queries taken at once.
TILE, BLOCK, _AT_ONCE = 8192, 2048, 256
#: Lists at most, rows of the sample for each, and rows of it that give the first limits.
MOST_LISTS, _PER_LIST, _LIMIT_ROWS = 4096, 32, 4096
#: Queries that the number of probes is fitted on, and the recall that it has to reach there.
_TRIAL, TARGET = 200, 0.97
#: Chance that a test abandons a candidate wrongly, and the share of candidates below which they are
#: followed one by one.
_RISK, _SPARSE = 0.001, 0.1
#: Rows within a query's first limit beyond those asked for.
_SPARE = 4
#: Rounding of distances in single precision, in units of the largest norm's square.
_SLACK = 1e-5


@dataclass(frozen=True)
class Index:
    """Centroids of the lists (rows, in the scaled space), the scale, and rows that give queries their first
    limits, with their lists and the most of them that share an id."""

    centroids: np.ndarray
    scale: float
    sample: np.ndarray
    sample_lists: np.ndarray
    repeats: int


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and ``vector`` (of doubles) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
    rows = rows.where(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (length.n if length else 0))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as an array with a row per list."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def lifted(x: np.ndarray, scale: float) -> np.ndarray:
    """Rows scaled into the unit ball, with the coordinate that puts them on its surface."""
    x = x / scale
    return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))], axis=1)


def _unlifted(q: np.ndarray, scale: float) -> np.ndarray:
    return np.concatenate([q / scale, np.zeros((len(q), 1))], axis=1)


def _nearness(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances to the centroids, less each row's own square."""
    return (centroids * centroids).sum(axis=1) - 2 * (x @ centroids.T)


def fit(rows: DataFrame, most_lists: int = MOST_LISTS, rounds: int = 8) -> Index | None:
    """Lists around centroids of the rows with the smallest hashes; ``None`` without rows.

    There are as many lists as the root of the number of rows, ``most_lists`` at most, and a sample of
    ``_PER_LIST`` rows for each."""
    largest = F.array_max(F.transform("vector", F.abs))
    norm = largest * F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest)))
    many, scale = rows.agg(F.count("*"), F.max(norm)).first()
    if not many:
        return None
    lists = max(1, min(most_lists, round(many**0.5)))
    # At most most_lists * _PER_LIST rows.
    drawn = rows.orderBy(F.xxhash64("id"), "id", "vector").limit(lists * _PER_LIST).toArrow()
    vectors = matrix(drawn.column("vector"))
    ids = drawn.column("id").to_numpy()
    x = lifted(vectors, scale)
    centroids = x[np.linspace(0, len(x) - 1, min(lists, len(x))).astype(np.int64)]
    for _ in range(rounds):
        own = np.concatenate([_nearness(x[low : low + 4096], centroids).argmin(axis=1) for low in range(0, len(x), 4096)])
        order = np.argsort(own, kind="stable")
        full, starts = np.unique(own[order], return_index=True)
        centroids[full] = np.add.reduceat(x[order], starts, axis=0) / np.diff([*starts, len(x)])[:, None]
    centroids, first = np.unique(centroids, axis=0), x[:_LIMIT_ROWS]
    return Index(centroids, scale, vectors[:_LIMIT_ROWS], _nearness(first, centroids).argmin(axis=1), int(np.unique(ids, return_counts=True)[1].max()))


def listed(rows: DataFrame, index: Index) -> DataFrame:
    """The rows with their ``list``."""
    sent = rows.sparkSession.sparkContext.broadcast((index.centroids, index.scale))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, scale = sent.value
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                near = _nearness(lifted(matrix(part.column("vector")), scale), centroids)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near.argmin(axis=1), pa.int32())], names=["id", "vector", "list"])

    return rows.mapInArrow(run, "id long, vector array<double>, list int")


def _trial(rows: DataFrame, queries: DataFrame, index: Index, k: int, target: float) -> int:
    """The least number of probes that reaches the target for a few queries, by brute force over all rows."""
    # At most _TRIAL rows.
    drawn = queries.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(_TRIAL).toArrow()
    if not drawn.num_rows:
        return 1
    q, own = matrix(drawn.column("vector")), drawn.column("id").to_numpy()
    sent = rows.sparkSession.sparkContext.broadcast((q, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, own = sent.value
        for batch in batches:
            ids, held = batch.column("id").to_numpy(), batch.column("list").to_numpy()
            score = q @ matrix(batch.column("vector")).T
            score[own[:, None] == ids[None, :]] = -np.inf
            n = min(k, len(ids))
            best = np.argpartition(-score, n - 1, axis=1)[:, :n]
            at = np.repeat(np.arange(len(q)), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(score[at, best.ravel()]), pa.array(held[best.ravel()], pa.int32())], names=["q", "score", "list"]
            )

    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    best = rows.mapInArrow(run, "q int, score double, list int").where(F.col("score") > float("-inf"))
    # At most _TRIAL * k rows.
    true = best.withColumn("place", place).where(F.col("place") <= k).select("q", "list").toArrow()
    if not true.num_rows:
        return 1
    rank = np.argsort(np.argsort(_nearness(_unlifted(q, index.scale), index.centroids), axis=1, kind="stable"), axis=1)
    needed = np.sort(rank[true.column("q").to_numpy(), true.column("list").to_numpy()])
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]) + 1


@dataclass(frozen=True)
class _Plan:
    """First tile and number of tiles of each list, and the block of each tile's queries."""

    first: np.ndarray
    pieces: np.ndarray
    block: np.ndarray
    size: np.ndarray


def _plan(size: np.ndarray, queries: np.ndarray, order: np.ndarray) -> _Plan:
    """Lists side by side in the given order, a tile as full as ``TILE`` rows allow; long lists in pieces."""
    first, pieces, held = np.zeros(len(size), np.int64), np.ones(len(size), np.int64), []
    room = 0
    for at in order.tolist():
        n = int(size[at])
        if n > TILE:
            pieces[at] = -(-n // TILE)
            first[at], room = len(held), 0
            held += [queries[at] / pieces[at]] * int(pieces[at])
        else:
            if n > room:
                held.append(0)
                room = TILE
            first[at], room = len(held) - 1 if held else 0, room - n
            if held:
                held[-1] += queries[at]
    return _Plan(first, pieces, (np.cumsum([0.0, *held])[:-1] // BLOCK).astype(np.int64), size)


def _probes(queries: DataFrame, index: Index, plan: _Plan, probes: int, k: int) -> DataFrame:
    """A row for each query and tile that it probes: ``tile``, ``block``, ``id``, ``vector``, ``limit``, ``lists``."""
    sent = queries.sparkSession.sparkContext.broadcast((vars(index), vars(plan)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, plan = Index(**sent.value[0]), _Plan(**sent.value[1])
        sample = lifted(index.sample, index.scale)
        # Some more than needed, as a test may abandon one of them.
        wanted = k + index.repeats + _SPARE
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                q = _unlifted(matrix(part.column("vector")), index.scale)
                own = (q * q).sum(axis=1)
                order = np.argsort(_nearness(q, index.centroids), axis=1, kind="stable")
                # Lists that together hold too few rows don't count as probes.
                enough = np.cumsum(plan.size[order], axis=1) - plan.size[order] < wanted
                enough |= np.arange(order.shape[1]) < probes
                limit = np.full(len(q), np.inf)
                if len(sample) >= wanted:
                    probed = np.zeros(order.shape, dtype=bool)
                    np.put_along_axis(probed, order, enough, axis=1)
                    near = own[:, None] + (sample * sample).sum(axis=1) - 2 * (q @ sample.T)
                    near[~probed[:, index.sample_lists]] = np.inf
                    limit = np.partition(near, wanted - 1, axis=1)[:, wanted - 1]
                row, place = np.nonzero(enough)
                of = order[row, place]
                many = plan.pieces[of]
                row, of, piece = np.repeat(row, many), np.repeat(of, many), np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                tile = plan.first[of] + piece
                by = np.lexsort((of, tile, row))
                row, of, tile = row[by], of[by], tile[by]
                starts = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (tile[1:] != tile[:-1])]))
                at = row[starts]
                taken = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tile[starts]), pa.array(plan.block[part.column("tile").to_numpy()[at]]), taken.column("id"), taken.column("vector"), pa.array(limit[at]),
                     worker.lists(of, np.diff([*starts, len(of)]), pa.int32())],
                    names=["tile", "block", "id", "vector", "limit", "lists"],
                )

    return queries.mapInArrow(run, "tile long, block long, id long, vector array<double>, limit double, lists array<int>")


def beta_quantile(share: float, a: float, b: float) -> float:
    """The point that a beta variable exceeds with probability ``1 - share``, rounded up on a fine grid."""
    x = (np.arange(20_000) + 0.5) / 20_000
    density = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
    mass = np.cumsum(np.exp(density - density.max()))
    return float(min(1.0, (np.searchsorted(mass, share * mass[-1]) + 1) / 20_000))


def _rotation(size: int) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
    """A random rotation, and blocks of columns with the share of a distance that the columns up to there rarely exceed."""
    turned = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))[0].astype(np.float32)
    edges = sorted({0, *(max(1, size * i // 4) for i in (1, 2, 3)), size})
    return turned, [(a, b, 1.0 if b == size else beta_quantile(1 - _RISK, b / 2, (size - b) / 2)) for a, b in zip(edges, edges[1:])]


def distinct_rows(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows, each id and vector once, without those that ``k`` rows of equal vectors and smaller ids precede."""
    same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    order = np.lexsort((ids, same))
    new = np.concatenate([[True], (same[order][1:] != same[order][:-1]) | (ids[order][1:] != ids[order][:-1])])
    order = order[new]
    group = np.flatnonzero(np.concatenate([[True], same[order][1:] != same[order][:-1]]))
    place = np.arange(len(order)) - np.repeat(group, np.diff([*group, len(order)]))
    return np.sort(order[place < k])


def scores(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows of ``q`` and ``x``, summed up from the first component to the last."""
    total = np.zeros(len(i))
    for low in range(0, len(i), 1 << 16):
        at, to = i[low : low + (1 << 16)], j[low : low + (1 << 16)]
        for c in range(q.shape[1]):
            total[low : low + (1 << 16)] += q[at, c] * x[to, c]
    return total


class _Tile:
    """Rows of a tile, by list, in the rotated space."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, lists: np.ndarray, scale: float):
        by = np.lexsort((ids, lists))
        self.ids, self.x, self.scale = ids[by], np.asfortranarray(x[by]), scale
        self.names, self.starts = np.unique(lists[by], return_index=True)
        self.ends = np.append(self.starts[1:], len(ids))
        self.turn, self.blocks = worker.kept(("rotation", x.shape[1] + 1), lambda: _rotation(x.shape[1] + 1))
        self.turned = lifted(x[by], scale).astype(np.float32) @ self.turn
        self.repeats = int(np.unique(ids, return_counts=True)[1].max())

    def scan(self, q: np.ndarray, low: int, high: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of rotated queries and rows of a list, and their squared distances, that no test has abandoned."""
        x, whole = self.turned[low:high], np.zeros((len(q), high - low), dtype=np.float32)
        for n, (a, b, share) in enumerate(self.blocks):
            left, right = q[:, a:b], x[:, a:b]
            whole += (left * left).sum(axis=1)[:, None] + (right * right).sum(axis=1) - 2 * (left @ right.T)
            alive = whole <= (limit * share + _SLACK)[:, None]
            if np.count_nonzero(alive) < _SPARSE * alive.size:
                break
        i, j = np.nonzero(alive)
        part = whole[i, j]
        for a, b, share in self.blocks[n + 1 :]:
            apart = q[i, a:b] - x[j, a:b]
            part = part + (apart * apart).sum(axis=1)
            near = part <= limit[i] * share + _SLACK
            i, j, part = i[near], j[near], part[near]
        return i, j, part

    def nearest(self, own: np.ndarray, vectors: np.ndarray, limit: np.ndarray, probed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of the best rows of each query; ``probed`` says which lists it probes."""
        q, wanted = _unlifted(vectors, self.scale).astype(np.float32) @ self.turn, k + self.repeats
        best, limit, found = np.full((len(q), wanted), np.inf, dtype=np.float32), limit.astype(np.float32), []
        for at, (low, high) in enumerate(zip(self.starts, self.ends)):
            rows = np.flatnonzero(probed[:, at])
            if not len(rows):
                continue
            i, j, part = self.scan(q[rows], low, high, limit[rows])
            near = np.full((len(rows), wanted + high - low), np.inf, dtype=np.float32)
            near[:, :wanted] = best[rows]
            near[i, wanted + j] = part
            best[rows] = np.partition(near, wanted - 1, axis=1)[:, :wanted]
            limit[rows] = np.minimum(limit[rows], best[rows].max(axis=1))
            near = part <= limit[rows][i] + _SLACK
            found.append((rows[i[near]], j[near] + low, part[near]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        i, j, part = (np.concatenate([f[n] for f in found]) for n in range(3))
        near = (part <= limit[i] + _SLACK) & (self.ids[j] != own[i])
        i, j = i[near], j[near]
        score = scores(vectors, self.x, i, j)
        order = np.lexsort((self.ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        starts = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.zeros(0, np.int64)
        first = np.arange(len(i)) - np.repeat(starts, np.diff([*starts, len(i)])) < k
        return i[first], j[first], score[first]


def _meet(scale: float, k: int):
    """A tile and a block of queries in, the best rows of each query out."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        parts = []
        if rows.num_rows and queries.num_rows:
            ids, x, lists = rows.column("id").to_numpy(), matrix(rows.column("vector")), rows.column("list").to_numpy()
            keep = distinct_rows(ids, x, k + 1)
            tile = _Tile(ids[keep], x[keep], lists[keep], scale)
            own, vectors, limit = queries.column("id").to_numpy(), matrix(queries.column("vector")), queries.column("limit").to_numpy()
            flat = queries.column("lists").combine_chunks()
            of = np.repeat(np.arange(len(own)), flat.value_lengths().to_numpy(zero_copy_only=False))
            at = np.searchsorted(tile.names, probe := flat.flatten().to_numpy(zero_copy_only=False))
            there = (at < len(tile.names)) & (tile.names[np.minimum(at, len(tile.names) - 1)] == probe)
            probed = np.zeros((len(own), len(tile.names)), dtype=bool)
            probed[of[there], at[there]] = True
            for low in range(0, len(own), _AT_ONCE):
                part = slice(low, low + _AT_ONCE)
                i, j, score = tile.nearest(own[part], vectors[part], limit[part], probed[part], k)
                parts.append((own[part][i], tile.ids[j], score))
        columns = [np.concatenate([p[n] for p in parts]) if parts else [] for n in range(3)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def search(df: DataFrame, is_query: str, key: str = "vec_id", vector: str = "embedding", k: int = 20, target: float = TARGET, most_lists: int = MOST_LISTS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` nearest found of each row that
    ``is_query``, a condition on the column ``id``, holds for."""
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(df, key, vector)
    index = fit(rows, most_lists)
    if index is None:
        return empty
    rows = staged(listed(rows, index), "lists")
    queries = rows.where(is_query).groupBy("id").agg(F.min(F.struct("vector", "list")).alias("x")).select("id", "x.vector", "x.list")
    probes = _trial(rows, queries, index, k, target)
    # A row per list.
    held = rows.groupBy("list").agg(F.count("*").alias("n"), F.count_if(F.expr(is_query)).alias("queries")).toArrow()
    size, asked = np.zeros(len(index.centroids), np.int64), np.zeros(len(index.centroids), np.int64)
    size[held.column("list").to_numpy()], asked[held.column("list").to_numpy()] = held.column("n").to_numpy(), held.column("queries").to_numpy()
    if not asked.any():
        return empty
    # Lists with neighbouring centroids share a tile.
    spread = index.centroids - index.centroids.mean(axis=0)
    plan = _plan(size, asked, np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0], kind="stable"))
    places = df.sparkSession.createDataFrame([(i, int(f), int(p)) for i, (f, p) in enumerate(zip(plan.first, plan.pieces))], "list int, first long, pieces long")
    tile = (F.col("first") + F.expr("pmod(xxhash64(id, 11), pieces)")).alias("tile")
    # At most most_lists rows.
    tiled = rows.join(F.broadcast(places), "list").select("id", "vector", "list", tile)
    asking = queries.join(F.broadcast(places), "list").select("id", "vector", tile)
    asking = staged(_probes(asking, index, plan, probes, k), "probes")
    met = tiled.join(small_side(asking.select("tile", "block").distinct()), "tile")
    found = met.groupBy("tile", "block").cogroup(asking.groupBy("tile", "block")).applyInArrow(_meet(index.scale, k), "query_id long, vec_id long, score double")
    # Rows of equal id and vector may have met their query in two lists.
    found = found.repartition("query_id").dropDuplicates(["query_id", "vec_id", "score"])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
