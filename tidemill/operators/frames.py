"""Range frames: aggregates over the time before each row, in work that grows with the rows alone.

A frame reaches from ``back`` before a row up to its time, both included.  Time is cut into blocks as long as the
frame, so a frame is the end of one block and the beginning of the next, and its aggregate
is what is left of the one and what has come of the other: two running aggregates.  Every row is copied, without what it
does not need, to the next block with its time moved on by ``back``; so both are found within a block of a
key, by one shuffle and two sorts, and no row's frame is gone through again, as a sliding frame would.

No task holds a whole key: it is split by time.  A block with more than ``rows_per_range`` rows is cut further, at
places taken from a hashed sample, and what its ranges begin with follows from their totals.  Rows of one key
and instant stay in one task, which sorts them with spilling.

Nulls: a row without a key or time stays, with an empty frame, and is in no other's.  Aggregates leave
out null values; over none a count is 0 and the others are null.  Rows of a time see each other, repeated ones
count each.  Sums of floating point may differ in the last digits with the order of equal times.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.asof import ROWS_PER_RANGE, _range_of, _ranges
from tidemill.operators.ticks import MERGES, block, combined, contribution, length, ticks


def _running(kinds: list[str], mark: str, window) -> dict[str, Column]:
    return {f"_{mark}{i}": MERGES[kind](f"_{mark}{i}").over(window) for i, kind in enumerate(kinds)}


def _totals(rows: DataFrame, ranges: DataFrame, part: list[str], kinds: list[str]) -> DataFrame:
    """Of each range of a hot block, what the ranges before it (``_cv``) and after it (``_cw``) come to; as many rows as there are ranges."""
    marks = [(m, i, kind) for m in "vw" for i, kind in enumerate(kinds)]
    hot = rows.join(F.broadcast(ranges), part).withColumn("_range", _range_of(F.col("_order")))
    each = hot.groupBy(*part, "_range").agg(*(MERGES[kind](f"_{m}{i}").alias(f"_{m}{i}") for m, i, kind in marks))
    order = Window.partitionBy(*part).orderBy("_range")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*part).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    return each.select(*part, "_range", *(MERGES[kind](f"_{m}{i}").over(before if m == "v" else after).alias(f"_c{m}{i}") for m, i, kind in marks))


def frame_aggregates(
    df: DataFrame, by: list[str], at: str, back: timedelta | int, aggs: dict[str, tuple[str, Column | str | None]], rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Rows with, for each of ``aggs``, (kind, value) over the rows of their key within ``back`` up to their time.

    Kinds are count, sum, min and max; ``at`` is a timestamp, a date or a whole number, and ``back`` a span
    of time or a number in its unit.
    """
    size, kinds = length(back), [kind for kind, _ in aggs.values()]
    keys = [f"_k{i}" for i in range(len(by))]
    whole = reduce(lambda a, c: a & F.col(f"`{c}`").isNotNull(), [*by, at], F.lit(True))
    values = [contribution(kind, value) for kind, value in aggs.values()]
    named = [F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)]
    timed = df.filter(whole).select(*named, ticks(df, at).alias("_order"), *(v.alias(f"_v{i}") for i, v in enumerate(values)), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"))
    own = timed.withColumn("_block", block("_order", size))
    moved = own.select(*keys, (F.col("_order") + size).alias("_order"), (F.col("_block") + 1).alias("_block"), *(F.col(f"_v{i}").alias(f"_w{i}") for i in range(len(kinds))))
    rows, part = own.unionByName(moved, allowMissingColumns=True), [*keys, "_block"]
    ranges = _ranges(rows, part, rows_per_range)
    cut = part if ranges is None else [*part, "_range"]
    if ranges is not None:
        totals = _totals(rows, ranges, part, kinds)
        rows = rows.join(F.broadcast(ranges), part, "left").withColumn("_range", _range_of(F.col("_order"))).drop("_blocks")
    upto = lambda o: Window.partitionBy(*cut).orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumns({**_running(kinds, "v", upto(F.col("_order"))), **_running(kinds, "w", upto(F.desc("_order")))}).filter(F.col("_row").isNotNull())
    if ranges is not None:
        found = found.join(F.broadcast(totals), cut, "left")
    out = []
    for i, (name, kind) in enumerate(zip(aggs, kinds, strict=True)):
        sides = [F.col(f"_{m}{i}") for m in (("v", "w") if ranges is None else ("v", "w", "cv", "cw"))]
        one = reduce(lambda a, b, kind=kind: combined(kind, a, b), sides).cast(found.schema[f"_v{i}"].dataType)
        out.append((F.coalesce(one, F.lit(0).cast("bigint")) if kind == "count" else one).alias(name))
    done = found.select("_row.*", *out)
    empty = {n: F.lit(0 if kind == "count" else None).cast(done.schema[n].dataType) for n, kind in zip(aggs, kinds, strict=True)}
    return done.unionByName(df.filter(~whole).withColumns(empty))
