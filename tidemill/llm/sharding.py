"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts are one group and stay in one shard.  Groups, sorted by size, enter the
tightest shard that still takes them, found in a balanced tree of remaining capacities; the
smallest capacity at which the given number of shards suffices is searched for.  Groups of one size
are interchangeable, so the packing runs over counts of size classes.  Sizes of up to ``CLASS_BITS``
bits are classes of their own; of larger ones that many leading bits count, rounded up, so a class is
at most a part in 2 ** (``CLASS_BITS`` - 1) larger than its groups.  There are at most
2 ** (``CLASS_BITS`` - 1) classes for each further bit, 0.5 million in all, whatever the corpus, which
bounds what the driver holds and broadcasts.

A group larger than an even share can't stay whole while shards are near equal: it alone is cut,
into parts of at most an even share.  There are fewer of them than shards.

Nulls: a null text is empty.  Rows without a key count like others, and so do rows of one key.  Ties in
the order of slots go by key, then group.  A very long text is a group that may exceed an even share;
a single one stays whole.  An empty table gives no rows.  The input's columns may have any names;
among ``carry``, one that is named like a column of the result is replaced by it.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.ranks import ROWS_PER_SALT, numbered
from tidemill.scratch import written


CLASS_BITS = 14
#: So many tasks may number rows of one key and text.
EQUAL = 256
RESULT = ("size", "group_id", "shard", "slot")


def size_class(size: Column) -> Column:
    """The size of its class: the size itself, or rounded up to CLASS_BITS leading bits."""
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.length(F.bin(size)) - CLASS_BITS))
    return (F.ceil(size / step) * step).cast("long")


def _class_of(size: int) -> int:
    step = 1 << max(0, size.bit_length() - CLASS_BITS)
    return -(-size // step) * step


class Tree:
    """A height-balanced search tree of distinct (remaining, bin) pairs."""

    def __init__(self):
        self._root = None

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    @classmethod
    def _node(cls, left, pair, right):
        return (left, pair, right, 1 + max(cls._height(left), cls._height(right)))

    @classmethod
    def _joined(cls, left, pair, right):
        tilt = cls._height(left) - cls._height(right)
        if tilt > 1:
            a, p, b, _ = left
            if cls._height(a) >= cls._height(b):
                return cls._node(a, p, cls._node(b, pair, right))
            c, q, d, _ = b
            return cls._node(cls._node(a, p, c), q, cls._node(d, pair, right))
        if tilt < -1:
            a, p, b, _ = right
            if cls._height(b) >= cls._height(a):
                return cls._node(cls._node(left, pair, a), p, b)
            c, q, d, _ = a
            return cls._node(cls._node(left, pair, c), q, cls._node(d, p, b))
        return cls._node(left, pair, right)

    def add(self, pair: tuple[int, int]) -> None:
        def put(node):
            if node is None:
                return (None, pair, None, 1)
            a, p, b, _ = node
            return self._joined(put(a), p, b) if pair < p else self._joined(a, p, put(b))

        self._root = put(self._root)

    def take_at_least(self, remaining: int) -> tuple[int, int] | None:
        """Remove and return the smallest pair with that much remaining or more."""
        found, node = None, self._root
        while node:
            if node[1][0] >= remaining:
                found, node = node[1], node[0]
            else:
                node = node[2]
        if found:
            self._root = self._without(self._root, found)
        return found

    @classmethod
    def _without(cls, node, pair):
        a, p, b, _ = node
        if pair < p:
            return cls._joined(cls._without(a, pair), p, b)
        if pair > p:
            return cls._joined(a, p, cls._without(b, pair))
        if a is None or b is None:
            return a or b
        least = b
        while least[0]:
            least = least[0]
        return cls._joined(a, least[1], cls._without(b, least[1]))


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, limit: int | None = None) -> list[list[tuple[int, int]]] | None:
    """For (size, count) classes by falling size, the (bin, how many) runs of each.

    None if more than ``limit`` bins would be needed.  After an item enters the tightest bin that
    takes it, this bin is the tightest for the next of its size too, so each step fills a bin.
    """
    tree, used, out = Tree(), 0, []
    for size, count in classes:
        runs = []
        while count:
            if (found := tree.take_at_least(size)) is None:
                if size > capacity or used == limit:
                    return None
                found, used = (capacity, used), used + 1
            remaining, at = found
            n = min(count, remaining // size)
            runs.append((at, n))
            count -= n
            tree.add((remaining - n * size, at))
        out.append(runs)
    return out


def fitted(classes: list[tuple[int, int]], bins: int) -> tuple[int, list[list[tuple[int, int]]]]:
    """A least capacity, up to a factor of two in what it adds to the necessary, and the runs at it."""
    least = max([math.ceil(sum(s * n for s, n in classes) / bins), *(s for s, _ in classes[:1]), 1])
    more = 0
    while (runs := best_fit_decreasing(classes, least + more, bins)) is None:
        more = max(1, 2 * more)
    return least + more, runs


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row (key, *carry, size, group_id, shard, slot) per document.

    ``size`` is the text's UTF-8 bytes and 1.  ``slot`` numbers a shard's rows from 0 without gaps.
    """
    spark = docs.sparkSession
    carry = tuple(c for c in carry if c.lower() not in {key.lower(), *RESULT})
    body = F.coalesce(F.col(text), F.lit(""))
    # The input's columns get numbers for names here, so that none clashes.
    given, key, carry = (key, *carry), "_c0", tuple(f"_c{i + 1}" for i in range(len(carry)))
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(given, (key, *carry), strict=True)), (F.octet_length(body) + 1).cast("long").alias("size"), F.unhex(F.sha2(body, 256)).alias("group_id"), (F.rand(11) * EQUAL).cast("int").alias("_equal"))
    # Equal rows are told apart by a number of their own, written here, so that numbering can split them.
    rows = written(rows, "sized")
    groups = written(rows.groupBy("group_id", "size").agg(F.count("*").alias("n")).withColumn("unit", F.col("n") * F.col("size")), "groups")
    n_rows, total = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("unit"), F.lit(0))).first()
    share = math.ceil(total / shards) if total else 1

    # Fewer than ``shards`` groups can exceed an even share.  A single text that does stays whole.
    large = groups.filter((F.col("unit") > share) & (F.col("n") > 1)).select("group_id", "size", "n").collect()
    parts = {}
    for g in large:
        per = max(1, share // g["size"])
        parts[bytes(g["group_id"])] = [(min(per, g["n"] - at), at) for at in range(0, g["n"], per)] if per > 1 else None
    cut = {k: v for k, v in parts.items() if v}
    whole = groups.filter(~F.col("group_id").isin([bytearray(k) for k in cut])) if cut else groups

    whole = whole.withColumn("unit", size_class(F.col("unit")))
    counted = whole.groupBy("unit").agg(F.count("*").alias("count")).toArrow()
    classes: dict[int, int] = dict(zip(counted.column("unit").to_pylist(), counted.column("count").to_pylist(), strict=True))
    sizes = {bytes(g["group_id"]): g["size"] for g in large}
    chunks: dict[int, list[tuple[bytes, int]]] = {}
    for k, v in cut.items():
        for i, (n, _) in enumerate(v):
            chunks.setdefault(_class_of(n * sizes[k]), []).append((k, i))
    ordered = sorted(({u: classes.get(u, 0) + len(chunks.get(u, ())) for u in {*classes, *chunks}}).items(), reverse=True)
    _, runs = fitted(ordered, shards)

    plan, placed = [], {}
    for (unit, _), own in zip(ordered, runs, strict=True):
        flat = [[at, n] for at, n in own]
        for chunk in chunks.get(unit, ()):
            placed[chunk] = flat[0][0]
            flat[0][1] -= 1
            if not flat[0][1]:
                flat.pop(0)
        if flat:
            upto, bound = 0, []
            for _, n in flat:
                upto += n
                bound.append(upto)
            plan.append((unit, max(1, math.ceil(upto / ROWS_PER_SALT)), bound, [at for at, _ in flat]))
    schema = pa.schema([("unit", pa.int64()), ("salts", pa.int64()), ("bound", pa.list_(pa.int64())), ("at", pa.list_(pa.int32()))])
    columns = [list(c) for c in zip(*plan, strict=True)] if plan else [[], [], [], []]
    planned = spark.createDataFrame(pa.table(columns, schema=schema))

    ranked = numbered(written(whole.join(F.broadcast(planned), "unit"), "planned"), ["unit"], ["group_id"], ["group_id"], F.col("salts"), "rank")
    index = F.size(F.filter("bound", lambda b: b <= F.col("rank"))) + 1
    homes = written(ranked.select("group_id", "n", F.element_at("at", index).alias("shard")), "homes")

    # At most 1,000 groups hold over a thousandth of the rows; they alone would make a join uneven.
    heavy = F.col("n") > max(1, n_rows / 1000)
    often = F.broadcast(homes.filter(heavy).select("group_id", F.col("shard").alias("_shard")))
    usual = rows.filter(~F.col("group_id").isin([bytearray(k) for k in cut])) if cut else rows
    known = usual.join(often, "group_id", "left")
    kept = [key, *carry, "size", "group_id", "shard", "_equal"]
    found = known.filter(F.col("_shard").isNotNull()).withColumnRenamed("_shard", "shard").select(*kept)
    found = found.unionByName(known.filter(F.col("_shard").isNull()).join(homes.filter(~heavy).drop("n"), "group_id").select(*kept))
    for k, v in cut.items():
        own = rows.filter(F.col("group_id") == F.lit(bytearray(k)))
        n = sum(x for x, _ in v)
        own = numbered(own, ["group_id"], [key], [key, "_equal"], F.lit(math.ceil(n / ROWS_PER_SALT)), "rank")
        at = F.array(*(F.lit(placed[k, i]) for i in range(len(v))))
        found = found.unionByName(own.withColumn("shard", F.element_at(at, (F.floor(F.col("rank") / v[0][0]) + 1).cast("int"))).select(*kept))
    out = numbered(written(found, "sharded"), ["shard"], [key, "group_id"], [key, "group_id", *carry, "_equal"], F.lit(max(1, math.ceil(n_rows / shards / ROWS_PER_SALT))), "slot")
    return out.select(*(F.col(n).alias(c) for c, n in zip(given, (key, *carry), strict=True)), *RESULT)


def write_shards(docs: DataFrame, shards: int, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write each shard's rows under ``path``/shard=N."""
    carry = tuple(c for c in docs.columns if c not in (key, "size", "group_id", "shard", "slot"))
    assign(docs, shards, key, text, carry).drop("group_id").repartition("shard", F.floor(F.col("slot") / ROWS_PER_SALT)).write.partitionBy("shard").parquet(path)
