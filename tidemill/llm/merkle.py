"""Merkle manifests: a digest over every row, and for each row the path that proves it.

Rows are leaves of one tree per group, ordered within it; the trees' roots, ordered by group, are the
leaves of a last tree.  While several nodes remain, every ``ARITY`` consecutive ones become their
digest.  Nodes are lowercase hex SHA-256 over the concatenated hex text of what they stand for.

Trees are built and walked in aligned blocks of ``ARITY ** BLOCK_LEVELS`` leaves, so that a hot
group is many tasks.  Going up, a task streams a block's leaves past a stack of at most ``ARITY - 1`` open
nodes a level and gives the block's root; the roots are the leaves of the next tier, until each group
has one.  Going down, ``traversal`` walks a block leaf by leaf: it holds the current run of each
level and one treehash stack a level that makes the next run, and gives as many leaf steps per leaf as
there are levels to the stack whose lowest node is lowest.  Finished nodes close up, so what it
holds is a few runs a level, however long the block.  The path above the block is the same for all
of its leaves and is appended to each: it comes as one row ahead of the block's.

Nulls: a null field is told from an empty one, a null group comes first and is a group of its own,
a null key comes first.  Rows with equal keys go by their digests; rows equal in all that is hashed
are interchangeable.  An empty table gives no rows and has no root.  Texts are hashed whole, by Spark;
no text is shuffled.  Further columns are carried, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.scratch import written

ARITY = 8
BLOCK_LEVELS = 4
#: Rows after which block roots are given out.
FLUSH = 4096
#: One step of a path: what stands before and after the node in its run, and together with it makes the next.
PATH = T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())]))


def leaf_of(*fields: Column) -> Column:
    """The digest of a row: of each field ``-`` if it is null, else its UTF-8 bytes' count, a colon and itself."""
    parts = (F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields)
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path as one text, level by level, each level from left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels_of(n: int, most: int) -> int:
    """How many times ``n`` nodes are joined until one is left; ``most`` times in a block."""
    levels = 0
    while n > 1 and levels < most:
        levels, n = levels + 1, -(-n // ARITY)
    return levels


class Treehash:
    """Nodes of one level from leaves that arrive in order; holds the open runs of the levels below."""

    def __init__(self, level: int):
        self.level = level
        self.open: list[list[str]] = [[] for _ in range(level)]
        self.made: list[str] = []

    def add(self, node: str) -> None:
        for run in self.open:
            run.append(node)
            if len(run) < ARITY:
                return
            node = digest(run)
            run.clear()
        self.made.append(node)

    def close(self) -> list[str]:
        """The nodes, when no leaf follows: runs that are shorter are nodes too."""
        for level, run in enumerate(self.open):
            if run:
                node = digest(run)
                run.clear()
                (self.open[level + 1] if level + 1 < self.level else self.made).append(node)
        return self.made

    def lowest(self) -> int:
        """The level of the lowest node that it holds; its own, if it holds none below."""
        return next((level for level, run in enumerate(self.open) if run), self.level)

    def held(self) -> int:
        return len(self.made) + sum(map(len, self.open))


def traversal(leaves: list[str], levels: int, watch=None) -> Iterator[list[tuple[str, str]]]:
    """The path of each leaf up to the root of ``levels`` levels, one after another.

    ``leaves`` may be anything that gives a leaf by its number.  ``watch`` is told the number of nodes held
    at each leaf.
    """
    n = len(leaves)
    first = [Treehash(level) for level in range(levels)]
    for level, tree in enumerate(first):
        for i in range(min(n, ARITY ** (level + 1))):
            tree.add(leaves[i])
    current = [tree.close() for tree in first]
    # Of each level: the stack of the run to come, the next leaf that it takes and the last.
    coming = [[Treehash(level), ARITY ** (level + 1), min(n, 2 * ARITY ** (level + 1))] for level in range(levels)]
    for i in range(n):
        for level in range(levels):
            span = ARITY ** (level + 1)
            if i and i % span == 0:
                tree, at, end = coming[level]
                for k in range(at, end):
                    tree.add(leaves[k])
                current[level] = tree.close()
                coming[level] = [Treehash(level), i + span, min(n, i + 2 * span)]
        path = []
        for level in range(levels):
            own, run = i // ARITY**level % ARITY, current[level]
            path.append(("".join(run[:own]), "".join(run[own + 1 :])))
        yield path
        for _ in range(levels):
            busy = [c for c in coming if c[1] < c[2]]
            if not busy:
                break
            turn = min(busy, key=lambda c: c[0].lowest())
            turn[0].add(leaves[turn[1]])
            turn[1] += 1
        if watch is not None:
            watch(sum(map(len, current)) + sum(c[0].held() for c in coming))


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows of one block, from batches that are sorted by it; a block is bounded."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        keys = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True))
        start = 0
        for i, key in enumerate(keys):
            if key != now:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, now = [], i, key
        if len(keys) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _dealt(df: DataFrame) -> DataFrame:
    """Each block in one task, its rows in order."""
    return df.repartition("_group", "_block").sortWithinPartitions("_group", "_block", "_at")


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    at = F.col("_pos") % ARITY**levels
    return nodes.withColumns({"_block": ((F.col("_pos") - at) / ARITY**levels).cast("long"), "_at": at.cast("int")})


def _block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """The next tier: (_group, _pos, _n, _node) of each block's root, from (_group, _pos, _n, _node)."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, out = None, None, []

        def done():
            out.append((*now, -(-size // ARITY**levels), tree.close()[0]))

        size = 0
        for batch in batches:
            for group, block, n, node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (group, block) != now:
                    if now is not None:
                        done()
                    now, size, tree = (group, block), n, Treehash(levels_of(n, levels))
                tree.add(node)
            if len(out) >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["_group", "_pos", "_n", "_node"])
                out.clear()
        if now is not None:
            done()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["_group", "_pos", "_n", "_node"])

    return _dealt(_in_blocks(nodes, levels)).select("_group", "_block", "_n", "_node").mapInArrow(up, "_group string, _pos long, _n long, _node string")


def _walked(nodes: DataFrame, above: DataFrame, most: int) -> DataFrame:
    """``nodes`` with the ``_path`` and ``_subroot`` of each, from those of their blocks' roots ``above``."""
    kept = nodes.columns
    heads = above.select("_group", F.col("_pos").alias("_block"), F.lit(-1).alias("_at"), "_path", "_subroot")
    both = _in_blocks(nodes, most).unionByName(heads, allowMissingColumns=True)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in nodes.schema), T.StructField("_path", PATH), T.StructField("_subroot", T.StringType())])

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, ["_group", "_block"]):
            shared = [(s["before"], s["after"]) for s in block.column("_path")[0].as_py()]
            rows = block.slice(1).select(kept).combine_chunks()
            leaves, levels = rows.column("_node").to_pylist(), levels_of(rows.column("_n")[0].as_py(), most)
            flat = [step for path in traversal(leaves, levels) for step in (*path, *shared)]
            before, after = zip(*flat, strict=True) if flat else ((), ())
            steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], names=["before", "after"])
            offsets = pa.array(np.arange(len(leaves) + 1, dtype=np.int32) * (levels + len(shared)))
            subroot = pa.array([block.column("_subroot")[0].as_py()] * len(leaves), pa.string())
            yield pa.RecordBatch.from_arrays([*(c.chunk(0) for c in rows.columns), pa.ListArray.from_arrays(offsets, steps), subroot], names=schema.names)

    return _dealt(both).select(*kept, "_block", "_path", "_subroot").mapInArrow(down, schema)


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``_pos``, 0, 1, 2 ... by ``order`` within each group, and ``_n``, the group's rows.

    Rows are sorted over all tasks, so a group may be any share of them.  ``rows`` should be a written
    table; equal rows must differ in ``order`` where they may be many.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = rows.columns
    sorted_ = rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    ids = written(sorted_.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_row", 33)), "ordered")
    runs = ids.groupBy("_part", group).agg(F.min("_row").alias("_first"), F.count("*").alias("_here"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(group, "_part", (F.coalesce(F.sum("_here").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_here").over(Window.partitionBy(group)).alias("_n"))
    return ids.join(starts, ["_part", group]).select(*kept, (F.col("_row") + F.col("_shift")).alias("_pos"), "_n")


def _tiers(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` and the tiers above them, the last with one node a group."""
    tiers = [nodes]
    most = nodes.agg(F.max("_n")).first()[0] or 0
    while len(tiers) < 2 or most > 1:
        tiers.append(written(_block_roots(tiers[-1].select("_group", "_pos", "_n", "_node"), levels), "tier"))
        most = -(-most // ARITY**levels)
    return tiers


def _from_above(tiers: list[DataFrame], paths: DataFrame, levels: int) -> DataFrame:
    """The first of ``tiers`` with the paths of its rows, given those of the last: (_group, _pos, _path, _subroot)."""
    for tier in tiers[-2:0:-1]:
        paths = written(_walked(tier, paths, levels).select("_group", "_pos", "_path", "_subroot"), "paths")
    return _walked(tiers[0], paths, levels)


def prove(df: DataFrame, leaf: str, key: str, group: str, levels: int = BLOCK_LEVELS) -> DataFrame:
    """``df`` with ``subroot``, ``root`` and ``path``: the roots of the row's tree and of all, and the row's path to the latter.

    ``leaf`` holds the rows' digests, by which equal keys are ordered; blocks have ``levels`` levels.
    Columns of the three names are replaced.
    """
    added = ("subroot", "root", "path")
    given = [c for c in df.columns if c.lower() not in added]
    names = {c: f"_c{i}" for i, c in enumerate(given)}
    tree = F.coalesce(F.concat(F.lit("v"), F.col(f"`{group}`").cast("string")), F.lit(""))
    # Equal rows get a number of their own, written here, so that sorting can divide them.
    rows = df.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()), tree.alias("_group"), F.col(f"`{leaf}`").alias("_node"), (F.rand(12) * (1 << 30)).cast("int").alias("_equal"))
    placed = positions(written(rows, "leaves"), "_group", [names[key], "_node", "_equal"]).drop("_equal")
    tiers = _tiers(written(placed, "placed"), levels)
    tops = tiers[-1].select(F.col("_group").alias("_tree"), "_node", F.lit("").alias("_group"))
    last = _tiers(written(positions(written(tops, "subroots"), "_group", ["_tree"]), "last"), levels)
    found = last[-1].select("_node").first()
    start = last[-1].select("_group", "_pos", F.array().cast(PATH).alias("_path"), F.lit(None).cast("string").alias("_subroot"))
    trees = _from_above(last, start, levels).select(F.col("_tree").alias("_group"), F.lit(0).cast("long").alias("_pos"), "_path", F.col("_node").alias("_subroot"))
    out = _from_above(tiers, written(trees, "trees"), levels)
    return out.select(*(F.col(n).alias(c) for c, n in names.items()), F.col("_subroot").alias("subroot"), F.lit(found[0] if found else None).cast("string").alias("root"), F.col("_path").alias("path"))
