"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors of cosine c lie at squared distance 2 - 2c.  All are turned by one rotation and split
into blocks of about ``BLOCK`` dimensions; each block has a share of the squared distance as its
budget, in proportion to its variance.  If two vectors are near, some block keeps its budget.  The
rotation is to the principal axes of a sample of at most ``SAMPLE`` vectors and ``SAMPLE_BYTES``, picked
by a hash, dealt to the blocks in turn, so that each begins with the axes along which vectors spread
most; results do not depend on it.  Where the sample has no more vectors than dimensions, half of it gives the
axes and the other half how far vectors spread along them.  Vectors may have many lengths: those of most vectors get rotations, up
to ``PLAN_BYTES``, the others are blocked without one and compared in whole.

Each block is range-joined: a grid over those of its first axes that spread widely against the
block's radius has cells of twice the radius; a vector lives in one cell and visits the neighbouring
cells that its radius touches, so that any two within the radius meet in the cell of one of them.
To meet once, a vector visits only cells before its own.  The number of grid axes grows with the
logarithm of the number of vectors.  Where no axis spreads widely enough a grid would divide
nothing, and all such blocks together are one cell, in which a pair is tried by one block after
another.  Cells are compared in chunks of about ``CHUNK_BYTES``, each pair of chunks in one task,
whatever the cell's size.  Work on such a cell grows with the square of the number of vectors.

A pair that keeps a block's budget is verified at once, exactly and in double precision, by the
cosine of the given vectors.  It counts in the first block whose budget it keeps, so the union of
the blocks needs no shuffle.  Tasks report counts of links, and a forest of the linked vectors.

Equal vectors are one class, which is compared once and counts for all of its rows.

Nulls: vectors that are null or zero or hold null or non-finite components link with nothing, nor
do vectors of different lengths with each other.  Rows of one id are vectors of their own; links
that reach one of them reach the id.  A null id comes first in order and is null again in the result.
Finite components may be of any size: vectors are scaled by a power of two before anything is squared.
Repeated vectors are one class.  An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.components import components
from tidemill.scratch import written

COSINE = 0.9
BLOCK = 16
#: Bytes of the vectors of a chunk, in double precision.
CHUNK_BYTES = 1 << 23
#: A product of so many rows and columns is made at a time.
ROWS, COLUMNS = 128, 4096
#: About so many vectors per cell before another grid axis is used.
CELL = 1 << 14
SAMPLE, SAMPLE_BYTES = 1 << 13, 1 << 25
#: With fewer vectors in the sample than this, and than dimensions, a rotation is any.
FEW = 32
#: Rotations of all lengths together; lengths of fewer vectors beyond that are blocked as they stand.
PLAN_BYTES = 1 << 28
#: Stands for all the blocks without a grid.
FLAT = -1
#: An axis divides well if its standard deviation is so many radii.
WIDE = 2.0
#: What rounding may add to a squared distance, in double and in single precision.
ROUNDING, SINGLE = 1e-9, 1e-5
_NONE = -(1 << 63)


@dataclass
class Plan:
    """How vectors of one number of dimensions are turned, blocked and gridded."""

    turn: np.ndarray | None
    bounds: list[tuple[int, int]]
    budgets: np.ndarray
    grids: list[int]

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        """Turned unit vectors, computed row by row so that a vector's result is always the same."""
        unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
        return unit if self.turn is None else np.stack([np.einsum("ij,j->i", unit, row) for row in self.turn], axis=1)

    def dealt(self) -> list[int]:
        """The blocks with a grid, and ``FLAT`` if there are others."""
        return [b for b, g in enumerate(self.grids) if g] + [FLAT] * (0 in self.grids)

    def blocks(self, block: int) -> list[int]:
        return [b for b, g in enumerate(self.grids) if not g] if block == FLAT else [block]


def rotated(lengths: dict[int, int]) -> set[int]:
    """The lengths, with their numbers of vectors, that get a rotation."""
    total, found = 0, set()
    for d in sorted(lengths, key=lambda d: (-lengths[d], d)):
        if (total := total + 8 * d * d) <= PLAN_BYTES or not found:
            found.add(d)
    return found


def planned(d: int, sample: np.ndarray, n: int, cosine: float, turning: bool = True) -> Plan:
    """A plan from a sample of vectors of ``d`` dimensions, of ``n`` in all."""
    if not turning:
        turn, variance = None, np.full(d, 1e-12)
    elif d >= len(sample) >= FEW:
        unit = sample / np.sqrt(np.einsum("ij,ij->i", sample, sample))[:, None]
        fit, held = unit[::2] - unit[::2].mean(axis=0), unit[1::2]
        axes = np.linalg.svd(fit, full_matrices=True)[2]
        # Vectors that an axis was fitted to seem to spread wider along it than others do.
        spread = np.maximum((held @ axes.T).var(axis=0), 1e-12)
        falling = np.argsort(-spread, kind="stable")
        turn, variance = axes[falling], spread[falling]
    elif len(sample) > d:
        unit = sample / np.sqrt(np.einsum("ij,ij->i", sample, sample))[:, None]
        values, axes = np.linalg.eigh(np.cov(unit.T).reshape(d, d))
        turn, variance = axes.T[::-1], np.maximum(values[::-1], 1e-12)
    else:
        turn, variance = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0], np.full(d, 1e-12)
    count = max(1, round(d / BLOCK))
    order = np.concatenate([np.arange(b, d, count) for b in range(count)])
    turn, variance = turn[order] if turning else None, variance[order]
    edges = np.r_[0, np.cumsum([len(range(b, d, count)) for b in range(count)])].tolist()
    bounds = list(zip(edges, edges[1:], strict=False))
    # In proportion to variance, yet not below half of an even share.
    share = np.array([variance[a:b].sum() for a, b in bounds])
    share = 0.5 * share / share.sum() + 0.5 * np.array([b - a for a, b in bounds]) / d
    budgets = (2 - 2 * cosine) * share + ROUNDING
    most = max(0, math.ceil(math.log(max(1, n / CELL), 4)))
    grids = []
    for (a, b), budget in zip(bounds, budgets, strict=True):
        wide = np.sqrt(variance[a:b]) >= WIDE * math.sqrt(budget)
        grids.append(min(most, int(np.argmin(np.r_[wide, False]))))
    return Plan(np.ascontiguousarray(turn) if turning else None, bounds, budgets, grids)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors times powers of two that bring their largest component between 0.5 and 1."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _cells(points: np.ndarray, radius: float) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Home cells, a row of grid coordinates per point, and the (points, cells) of their visits before home."""
    width = 2 * radius
    home = np.floor(points / width).astype(np.int64)
    inside = points - home * width
    # Within its cell a point is nearer than the radius to one of the two borders, or to both.
    step = np.stack([np.where(inside <= radius, -1, 0), np.where(inside >= radius, 1, 0)])
    visits = []
    for choice in range(1, 3 ** points.shape[1]):
        digits = [choice // 3**k % 3 for k in range(points.shape[1])]
        move = np.stack([np.zeros(len(points), np.int64) if g == 0 else step[g - 1, :, k] for k, g in enumerate(digits)], axis=1)
        valid = np.all((move != 0) | (np.array(digits) == 0), axis=1)
        first = move[np.arange(len(move)), np.argmax(move != 0, axis=1)]
        at = np.flatnonzero(valid & (first < 0))
        if len(at):
            visits.append((at, home[at] + move[at]))
    return home, visits


def _key(block: int, d: int, cells: np.ndarray) -> np.ndarray:
    """A 64-bit name of a block's cell; cells of one name are compared together, which costs time only."""
    h = np.full(len(cells), (block * 1_000_003 + d) & 0xFFFFFFFF, dtype=np.uint64)
    for k in range(cells.shape[1]):
        h = (h ^ cells[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


class _Vectors:
    """Vectors as bytes of one number type, in groups of one length."""

    def __init__(self, kind: str, column):
        self.kind, self.raw = kind, column.to_pylist()
        self.lengths = np.array([len(x) for x in self.raw]) // np.dtype(kind).itemsize

    def groups(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(dimensions, rows, their vectors in double precision)."""
        for d in np.unique(self.lengths).tolist():
            rows = np.flatnonzero(self.lengths == d)
            yield d, rows, _scaled(np.frombuffer(b"".join(self.raw[i] for i in rows), dtype=self.kind).reshape(-1, d).astype(np.float64))


def _spread(vectors: DataFrame, plans, kind: str, whole: bool) -> DataFrame:
    """(cell, block, home, id, weight, v) rows: each vector at home in a cell of every block with a grid and of the others together, and on its visits; the first three alone unless ``whole``."""
    names = ["cell", "block", "home", *(["id", "weight", "v"] if whole else [])]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                for d, rows, found in _Vectors(kind, part.column(2)).groups():
                    plan = plans.value[d]
                    turned, own = plan.turned(found), part.take(pa.array(rows))
                    for b in plan.dealt():
                        first, grid = (plan.bounds[b][0], plan.grids[b]) if b != FLAT else (0, 0)
                        home, visits = _cells(turned[:, first : first + grid], math.sqrt(plan.budgets[b]))
                        for some, cells, here in [(np.arange(len(home)), home, True), *((*v, False) for v in visits)]:
                            more = own.take(pa.array(some)).columns if whole else []
                            yield pa.RecordBatch.from_arrays([pa.array(_key(b, d, cells)), pa.array(np.full(len(some), b, np.int32)), pa.array(np.full(len(some), here)), *more], names=names)

    return vectors.mapInArrow(deal, "cell long, block int, home boolean" + (", id long, weight long, v binary" if whole else ""))


def _compare(plan: Plan, ids: np.ndarray, weight: np.ndarray, home: np.ndarray, chunk: np.ndarray, i: int, j: int, block: int, vectors: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of one task's vectors that count in this block: (rows, their numbers of links, a forest's pairs)."""
    turned, size = plan.turned(vectors), np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    budgets, starts, tried = plan.budgets, [a for a, _ in plan.bounds], plan.blocks(block)
    sides = []
    for b in tried:
        part = turned[:, slice(*plan.bounds[b])]
        length = np.einsum("ij,ij->i", part, part)[:, None]
        # So extended, a product of two rows is their squared distance.
        left = np.hstack([-2 * part, length, np.ones_like(length)]).astype(np.float32)
        right = np.hstack([part, np.ones_like(length), length]).astype(np.float32)
        sides.append((left, right, np.float32(budgets[b] + SINGLE)))
    at_home = np.flatnonzero(home & (chunk == i))
    at_home = at_home[np.argsort(ids[at_home], kind="stable")]
    # Within a chunk, those at home follow in the order of their ids, and each meets the later ones.
    others = np.r_[at_home, np.flatnonzero(~home & (chunk == j))] if i == j else np.flatnonzero(chunk == j)
    sides = [(left[at_home], np.ascontiguousarray(right[others].T), most) for left, right, most in sides]
    links, part_of = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    forest: list[tuple[int, int]] = []

    tiles = ((r, c) for r in range(0, len(at_home), ROWS) for c in range(r if i == j else 0, len(others), COLUMNS))
    for r, c in tiles:
        hit = np.logical_or.reduce([left[r : r + ROWS] @ theirs[:, c : c + COLUMNS] <= most for left, theirs, most in sides])
        a, b = np.divmod(np.flatnonzero(hit), hit.shape[1])
        ok = b + c > a + r if i == j else slice(None)
        a, b = at_home[r + a[ok]], others[c + b[ok]]
        for k in range(0, len(a), 1 << 15):
            x, y = a[k : k + (1 << 15)], b[k : k + (1 << 15)]
            per = np.add.reduceat((turned[x] - turned[y]) ** 2, starts, axis=1)
            keeps = per <= budgets
            ok = keeps.any(axis=1) & np.isin(np.argmax(keeps, axis=1), tried)
            x, y = x[ok], y[ok]
            ok = np.einsum("ij,ij->i", vectors[x], vectors[y]) / (size[x] * size[y]) >= cosine
            x, y = x[ok], y[ok]
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
            # Most links lie within what is joined already; only the others are gone through.
            new = np.flatnonzero(part_of[x] != part_of[y])
            while len(new):
                for v, w in zip(x[new[:256]].tolist(), y[new[:256]].tolist(), strict=True):
                    p, q = part_of[v], part_of[w]
                    if p != q:
                        part_of[part_of == max(p, q)] = min(p, q)
                        forest.append((v, w))
                new = new[part_of[x[new]] != part_of[y[new]]]
    seen = np.flatnonzero(links)
    return seen, links[seen], forest


def _join(vectors: DataFrame, plans, kind: str, cosine: float) -> DataFrame:
    """(id, links, other): partial counts of links, and pairs (links null) of forests."""
    light = _spread(vectors, plans, kind, False)
    homes = light.groupBy("cell", "block").agg(F.sum(F.col("home").cast("long")).alias("m"), F.count("*").alias("k"))
    homes = written(homes.filter("m > 0 and k > 1"), "cells")
    rows = _spread(vectors, plans, kind, True).join(homes, ["cell", "block"])
    chunks = F.ceil(F.col("k") * F.octet_length("v") * (8 // np.dtype(kind).itemsize) / CHUNK_BYTES)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), chunks))
    every = F.sequence(F.lit(0).cast("long"), chunks - 1)
    # Vectors at home stand on the left of their own and later chunks, for visitors also of earlier
    # ones, and on the right of earlier ones; visitors stand on the right of all.
    left = F.transform(F.filter(every, lambda j: (j >= F.col("chunk")) | (F.col("k") > F.col("m"))), lambda j: F.struct(F.col("chunk").alias("i"), j.alias("j")))
    left = F.concat(left, F.transform(F.filter(every, lambda i: i < F.col("chunk")), lambda i: F.struct(i.alias("i"), F.col("chunk").alias("j"))))
    right = F.transform(every, lambda i: F.struct(i.alias("i"), F.col("chunk").alias("j")))
    dealt = rows.withColumn("at", F.explode(F.when(F.col("home"), left).otherwise(right)))
    dealt = dealt.select("cell", "block", F.col("at.i").alias("i"), F.col("at.j").alias("j"), "chunk", "home", "id", "weight", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def group(t: pa.Table) -> pa.RecordBatch:
            block, i, j = (t.column(k)[0].as_py() for k in (1, 2, 3))
            chunk, home, ids, weight = (t.column(k).to_numpy() for k in (4, 5, 6, 7))
            out_id, out_links, out_other = [], [], []
            for d, at, vectors in _Vectors(kind, t.column(8)).groups():
                seen, links, forest = _compare(plans.value[d], ids[at], weight[at], home[at], chunk[at], i, j, block, vectors, cosine)
                own = ids[at]
                out_id += own[seen].tolist() + [int(own[a]) for a, _ in forest]
                out_links += links.tolist() + [None] * len(forest)
                out_other += [None] * len(seen) + [int(own[b]) for _, b in forest]
            return pa.RecordBatch.from_arrays([pa.array(out_id, pa.int64()), pa.array(out_links, pa.int64()), pa.array(out_other, pa.int64())], names=["id", "links", "other"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            keys = [table.column(k).to_numpy() for k in range(4)]
            new = np.flatnonzero(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
            for a, b in zip(new, new[1:], strict=False):
                if b - a > 1:
                    yield group(table.slice(a, b - a))
            held = table.slice(new[-1]).to_batches()
        if held and sum(b.num_rows for b in held) > 1:
            yield group(pa.Table.from_batches(held))

    keys = ["cell", "block", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "id long, links long, other long")


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) per row of ``df``."""
    packed = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))
    usable = F.coalesce(F.forall(packed, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(packed, lambda x: x != 0), F.lit(False))
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(_NONE)).alias("id"), F.when(usable, packed).alias("p"))
    # Equal vectors are known by two hashes.
    rows = written(rows.withColumns({"h": F.xxhash64("p"), "g": F.xxhash64(F.lit(1), "p")}), "vectors")
    classes = written(rows.filter("p is not null").groupBy("h", "g").agg(F.first("p").alias("p"), F.min("id").alias("rep"), F.count("*").alias("weight")), "classes")
    # Different vectors may share a smallest id, so classes are told apart by numbers of their own.
    numbered = written(classes.withColumn("c", F.monotonically_increasing_id()), "numbered")
    kind = "<f4" if isinstance(df.schema[vector].dataType.elementType, T.FloatType) else "<f8"

    def binary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = [x.values.to_numpy(zero_copy_only=False).astype(kind).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p, pa.binary())], names=["id", "weight", "v"])

    vectors = written(numbered.select("c", "weight", "p").mapInArrow(binary, "id long, weight long, v binary"), "packed")
    n = {r["d"]: r["n"] for r in vectors.groupBy((F.octet_length("v") / np.dtype(kind).itemsize).cast("int").alias("d")).agg(F.count("*").alias("n")).collect()}
    most = min(SAMPLE, SAMPLE_BYTES // (8 * max(n, default=1)))
    sample = [np.frombuffer(bytes(r["v"]), dtype=kind).astype(np.float64) for r in vectors.select("v").orderBy(F.xxhash64("v"), "v").limit(most).collect()]
    of = lambda d: np.array([x for x in sample if len(x) == d]).reshape(-1, d)
    turning = rotated(n)
    plans = df.sparkSession.sparkContext.broadcast({d: planned(d, _scaled(x) if len(x := of(d)) else x, k, cosine, d in turning) for d, k in n.items()})
    found = written(_join(vectors, plans, kind, cosine), "links")
    counts = found.filter("links is not null").groupBy("id").agg(F.sum("links").alias("links"))
    names = numbered.select(F.col("c").alias("id"), "rep")
    pairs = found.filter("other is not null").join(names, "id").select(F.col("rep").alias("x"), "other").join(names.withColumnRenamed("id", "other"), "other").select("x", F.col("rep").alias("y"))
    # A class's rows are linked with one another, so its ids reach its smallest.
    own = rows.filter("p is not null").join(numbered.select("h", "g", "rep"), ["h", "g"]).select(F.col("rep").alias("x"), F.col("id").alias("y")).filter("x <> y")
    reached = components(pairs.unionByName(own), "x", "y")
    known = numbered.join(counts, F.col("c") == F.col("id"), "left").select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.select("id", F.when(F.col("p").isNotNull(), F.col("h")).alias("h"), "g").join(known, ["h", "g"], "left").join(reached, F.col("id") == F.col("v"), "left")
    component = F.coalesce("component", "id")
    real = lambda c: F.when(c != _NONE, c)
    return out.select(real(F.col("id")).alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), real(component).alias("component_id"), (F.col("id") == component).alias("kept"))
