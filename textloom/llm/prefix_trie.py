"""The trie of all conversations' beginnings, by cutting sequences at half depth.

A node is a distinct sequence of first turns. To name nodes without walking down turn by turn, the
turns of a conversation are cut at half depth, and each half again, as in a van Emde Boas layout, down
to pieces of ``PIECE`` turns, which one row holds. Going up, two neighbouring blocks' digests make their
union's; going down, the name of a cut prefix is made of the name of the prefix that its block starts
from and the digest of the block's upper half, so that the upper and the lower halves of all blocks go
on in parallel. A conversation of d turns takes about log d rounds, each over fewer rows than the last.

Totals of subtrees go the other way. Each piece adds up its own nodes in its row. Then, level by level,
the root of each lower block grafts its total onto the nodes above it in the upper block, which are the
names on the path of any of its members; the smallest member stands for all. No conversation's turns
are brought together beyond a piece, so that one may hold a third of all rows.

Defined results: a null role or text is an empty one; turns of equal number are ordered by role and
text, repeated rows are turns of their own; rows without a conversation id belong to none and are left
out; conversations without turns after rebuilding end at the root; an empty table gives no rows, not
even a root; texts of any length count whole; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.frames import side_by_side
from textloom.plans.session import staged

#: Turns of a piece, which one row holds.
PIECE = 8
#: Turns, and conversation ids in a row, that share a key of a join or a group.
_SLOT = 4096
#: A node with more than this part of all children is joined to them by broadcast: fewer than so many are.
_HOT = 1000


def _short(x: str) -> str:
    return f"substring(unhex(sha2({x}, 256)), 1, 16)"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of turns among those of their conversation in this task; rows come in order."""
    part, last, many = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        place = np.arange(len(conv)) - np.repeat(starts, np.diff([*starts, len(conv)]))
        if conv[0] == last:
            place[: starts[1] if len(starts) > 1 else len(conv)] += many
        last, many = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(conv), part), pa.int32()), pa.array(place, pa.int64())], names=["conv", "turn", "chars", "part", "place"]
        )


def turns(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 0), ``turn`` (a digest of role and text) and ``chars`` of every turn."""
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("at"), *(F.coalesce(F.col(c), F.lit("")).alias(to) for c, to in ((role, "role"), (text, "text")))
    )
    order = ["conv", "at", "role", "text"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    digest = _short("concat(CAST(octet_length(role) AS STRING), ':', role, text)")
    numbered = ordered.select("conv", F.expr(digest).alias("turn"), F.length("text").alias("chars")).mapInArrow(
        _number, "conv long, turn binary, chars int, part int, place long"
    )
    numbered = staged(numbered, "turns")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy("conv", "part").agg(F.count("*").alias("n"))
    # Only the first conversation of a task can go on from tasks before, so there is one row per task at most.
    carried = counts.withColumn("before", F.sum("n").over(before)).where("before > 0").select("conv", "part", "before")
    return numbered.join(F.broadcast(carried), ["conv", "part"], "left").select(
        "conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "turn", "chars"
    )


def rebuilt(rows: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their hundred does: all of them (``conv``, ``length``), and
    their turns (``conv``, ``length``, ``idx`` from 0, ``turn``, ``chars``).

    The first crc32(id) mod ``most`` turns are those of conversation id - id % ``group``, as far as it has them."""
    size = rows.groupBy("conv").agg(F.count("*").alias("n"))
    heads = rows.where((F.col("conv") % group == 0) & (F.col("pos") < most - 1))
    heads = heads.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "turn", "chars"))).alias("head"))
    convs = size.withColumn("base", F.col("conv") - F.col("conv") % group).join(heads, "base", "left")
    convs = convs.withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int"))
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h"))).withColumn("k", F.size("head"))
    convs = staged(convs.withColumn("length", F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("k")).drop("base"), "rebuilt")
    # A long conversation is met slot by slot.
    slots = convs.select("conv", "h", "k", "length", F.explode(F.expr(f"sequence(0L, (n - 1) div {_SLOT})")).alias("slot"))
    own = rows.withColumn("slot", F.expr(f"pos div {_SLOT}")).join(slots, ["conv", "slot"]).where("pos >= h")
    own = own.select("conv", "length", (F.col("pos") - F.col("h") + F.col("k")).alias("idx"), "turn", "chars")
    first = convs.select("conv", "length", F.explode("head").alias("x")).select("conv", "length", "x.pos", "x.turn", "x.chars")
    return convs.select("conv", "length"), own.unionByName(first.withColumnRenamed("pos", "idx"))


def _pieces(rows: DataFrame) -> DataFrame:
    """A row for each piece of a conversation, with the digests of its beginnings."""
    one = F.struct("idx", "turn", "chars")
    grouped = rows.groupBy("conv", F.expr(f"idx div {PIECE}").alias("piece")).agg(F.any_value("length").alias("length"), F.sort_array(F.collect_list(one)).alias("x"))
    begun = f"aggregate(x, CAST(array() AS array<binary>), (a, t) -> array_append(a, {_short('concat(coalesce(try_element_at(a, -1), X' + chr(39) * 2 + '), t.turn)')}))"
    return staged(grouped.select("conv", "piece", "length", F.expr(begun).alias("begun"), F.col("x.chars").alias("chars")), "pieces")


def _cut_names(pieces: DataFrame, levels: int) -> DataFrame:
    """``conv``, ``piece``, ``root``: the name of the prefix before each piece but the first."""
    block = staged(pieces.where(f"length > {PIECE} AND size(begun) = {PIECE}").select("conv", "piece", F.element_at("begun", PIECE).alias("digest")), "blocks")
    blocks = [block]
    for _ in range(levels - 1):
        both = F.sort_array(F.collect_list(F.struct("piece", "digest")))
        block = blocks[-1].groupBy("conv", F.expr("piece div 2").alias("half")).agg(both.alias("x")).where("size(x) = 2")
        block = block.select("conv", F.col("half").alias("piece"), F.expr(_short("concat(x[0].digest, x[1].digest)")).alias("digest"))
        blocks.append(staged(block, "blocks"))
    named = pieces.where(f"piece = 0 AND length > {PIECE}").select("conv", F.lit(0).cast("long").alias("piece"), F.expr("X''").alias("root"))
    named = staged(named, "cuts")
    for level in reversed(range(levels)):
        upper = blocks[level].select("conv", (F.col("piece") * (1 << level)).alias("piece"), "digest")
        lower = named.where(f"piece % {2 << level} = 0").join(upper, ["conv", "piece"])
        lower = lower.select("conv", (F.col("piece") + (1 << level)).alias("piece"), F.expr(_short("concat(root, digest)")).alias("root"))
        named = staged(named.unionByName(lower), "cuts")
    return named.where("piece > 0")


def _paths(pieces: DataFrame, levels: int) -> DataFrame:
    """``conv``, ``piece``, ``length``, ``names`` and ``chars`` of each piece's nodes, and ``above``, the name
    of the node before them."""
    names = F.expr(f"transform(begun, b -> {_short('concat(root, b)')})").alias("names")
    first = pieces.where("piece = 0").withColumn("root", F.expr("X''")).select("conv", "piece", "length", names, "chars", F.expr("X''").alias("above"))
    if not levels:
        return staged(first, "paths")
    later = pieces.where("piece > 0").join(_cut_names(pieces, levels), ["conv", "piece"]).select("conv", "piece", "length", names, "chars")
    later = staged(later, "paths")
    ends = first.where(f"length > {PIECE}").select("conv", "piece", "names").unionByName(later.select("conv", "piece", "names"))
    ends = ends.where(f"size(names) = {PIECE}").select("conv", (F.col("piece") + 1).alias("piece"), F.element_at("names", PIECE).alias("above"))
    return staged(first.unionByName(later.join(ends, ["conv", "piece"])), "paths")


def _nodes(paths: DataFrame) -> DataFrame:
    """A row per node but the root: ``name``, ``parent``, ``conv_id``, ``depth``, ``n_convs``, ``chars``, ``n_children``."""
    above = F.expr("concat(array(above), slice(names, 1, size(names) - 1))")
    each = paths.select("conv", "piece", F.posexplode(F.arrays_zip("names", "chars", above.alias("parents"))).alias("i", "x"))
    each = each.select("conv", (F.col("piece") * PIECE + F.col("i") + 1).alias("depth"), "x.names", "x.chars", "x.parents")
    nodes = each.groupBy(F.col("names").alias("name")).agg(
        F.any_value("parents").alias("parent"), F.min("conv").alias("conv_id"), F.any_value("depth").alias("depth"),
        F.count("*").alias("n_convs"), F.any_value("chars").alias("chars"),
    )
    nodes = staged(nodes, "nodes")
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    return staged(nodes.join(children, "name", "left").na.fill(0, ["n_children"]), "nodes")


def _grafted(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """``name``, ``saved`` and ``leaves``, totals over the subtree of each node, as rows to be added up."""
    own = F.struct("depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaves"))
    held = nodes.groupBy(F.col("conv_id").alias("conv"), F.expr(f"(depth - 1) div {PIECE}").alias("piece")).agg(F.sort_array(F.collect_list(own)).alias("own"))
    # The nodes that a conversation stands for are the last ones of its piece.
    below = "aggregate(slice(own, greatest(1, i - size(names) + size(own)), size(own)), 0L, (a, o) -> a + o.{0}) AS {0}"
    sums = f"transform(sequence(1, size(names)), i -> struct(names[i - 1] AS name, {below.format('saved')}, {below.format('leaves')}))"
    within = paths.select("conv", "piece", "names").join(held, ["conv", "piece"]).select(F.explode(F.expr(sums)).alias("x")).select("x.*")
    total = [F.sum(c).alias(c) for c in ("saved", "leaves")]
    grown = staged(within.groupBy("name").agg(*total), "grafts")
    if not levels:
        return grown
    long = staged(paths.where(f"length > {PIECE}").select("conv", "piece", "names"), "grafts")
    roots = nodes.where(f"depth > 1 AND depth % {PIECE} = 1").select("name", "conv_id", F.expr(f"depth div {PIECE}").alias("piece"))
    roots = staged(roots.join(grown, "name"), "grafts")
    for level in range(levels):
        cut = roots.where(f"piece % {2 << level} = {1 << level}")
        more = grown.join(cut.select("name"), "name", "left_semi").groupBy("name").agg(*total)
        cut = cut.select("name", F.col("conv_id").alias("conv"), F.expr(f"piece div {2 << level}").alias("block")).join(more, "name").drop("name")
        upper = long.where(f"piece % {2 << level} < {1 << level}").withColumn("block", F.expr(f"piece div {2 << level}"))
        added = upper.join(cut, ["conv", "block"]).select(F.explode("names").alias("name"), "saved", "leaves")
        grown = grown.unionByName(staged(added.groupBy("name").agg(*total), "grafts"))
    return grown


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each name's ids, which come in order."""
    name, state = None, None
    for batch in batches:
        found = []
        for this, ids in zip(batch.column("name").to_pylist(), batch.column("ids").cast(pa.binary()).to_pylist()):
            if this != name:
                if state is not None:
                    found.append((name, state.hexdigest()))
                name, state = this, hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.binary(), pa.string()))], names=["name", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], names=["name", "sha"])


def _ends(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """``name`` and ``sha``, the digest of the ids of the conversations that end at a node. A node's ids are
    joined in parts, in parallel, and the parts, some thousands of ids each, run through one digest."""
    last = paths.where(f"length <= (piece + 1) * {PIECE}").select(F.element_at("names", -1).alias("name"), "conv")
    last = last.unionByName(convs.where("length = 0").select(F.expr("X''").alias("name"), "conv"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    parts = last.groupBy("name", F.expr(f"(conv - pmod(conv, {_SLOT})) div {_SLOT}").alias("part")).agg(ids.alias("ids"))
    return parts.repartition("name").sortWithinPartitions("name", "part").select("name", "ids").mapInArrow(_hash_ids, "name binary, sha string")


def trie(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", group: int = 100, most: int = 6) -> DataFrame:
    """A row per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    convs, rows = rebuilt(turns(df, key, turn, role, text), group, most)
    pieces = _pieces(rows)
    last = pieces.agg(F.max("piece")).first()[0] or 0
    levels = int(last).bit_length()
    paths = _paths(pieces, levels)
    nodes = _nodes(paths)
    totals = _grafted(nodes, paths, levels).select("name", "saved", "leaves", F.lit(None).cast("string").alias("sha"))
    ends = _ends(convs, paths).select("name", F.lit(0).cast("long").alias("saved"), F.lit(0).cast("long").alias("leaves"), "sha")
    known = totals.unionByName(ends).groupBy("name").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.max("sha").alias("sha"))
    known = staged(known, "totals")

    of_root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"))
    below = nodes.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"), F.greatest(F.count_if(F.col("n_children") == 0), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("chars")), F.lit(0)).alias("saved_tokens"),
    )
    at_root = known.where("name = X''").agg(F.max("sha").alias("sha"))
    root = side_by_side([of_root, below, at_root]).where("conv_id IS NOT NULL")
    root = root.withColumns({"depth": F.lit(0).cast("long"), "parent_conv_id": F.lit(None).cast("long")})

    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    top = of_root.where("conv_id IS NOT NULL").select(F.expr("X''").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hot = F.lit(nodes.count() // _HOT)
    # Fewer than _HOT parents have more than that part of all nodes as children; none of the others is a hot key.
    few = F.broadcast(parents.where(F.col("n_children") > hot).drop("n_children").unionByName(top))
    rest = parents.where(F.col("n_children") <= hot).drop("n_children")
    plain = nodes.select("name", "parent", "conv_id", "depth", "n_convs", "n_children")
    placed = plain.join(few, "parent").unionByName(plain.join(few.select("parent"), "parent", "left_anti").join(rest, "parent").select("parent", *plain.drop("parent").columns, "parent_conv_id"))
    full = placed.join(known, "name")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")]
    return full.select(*columns).unionByName(root.select(*columns))
