"""As-of join: each left row with the last right row of its key up to its time.

Both sides go into one order by key and time, and the last right row is carried along it by a
window; nothing is joined by an inequality.  A key with more than ``rows_per_range`` rows is cut into
ranges of its order, at places taken from a hashed sample: every range is one group of the window,
and what a range begins with follows from the last right rows of those before it, a row or two a
range.  So the rows are shuffled once, and no task holds a hot key.

Nulls: a left row without a key or time has no match and takes no part in the shuffle; such right rows
match nothing.  Where several right rows have the time, the last by ``ties`` matches, and of rows equal
in these any one.  Every left row stays, also repeated ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.scratch import written

ROWS_PER_RANGE = 1_000_000
#: All ranges of all hot keys together, about, so that their bounds may be broadcast.
MOST_RANGES = 4096
SAMPLES = 40
#: Bounds are looked up in steps of so many.
STEP = 64


def _states(rows: DataFrame, part: list[str], order: list, other: bool) -> DataFrame:
    """Add the last right row up to each row, ``_s1``, and the last before it of another kind, ``_s2``."""
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not other:
        return rows.withColumn("_s1", F.last("_right", True).over(upto))
    before = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_s1": F.last("_right", True).over(upto), "_prev": F.last("_right", True).over(before)})
    change = F.when(F.col("_right").isNotNull() & F.col("_prev").isNotNull() & ~F.col("_prev._kind").eqNullSafe(F.col("_right._kind")), F.col("_prev"))
    return rows.withColumn("_s2", F.last(change, True).over(upto)).drop("_prev")


def _hashed(df: DataFrame) -> Column:
    """A hash of a row, for sampling and for an order of equal ones."""
    plain = [c for c, kind in df.dtypes if not any(x in kind for x in ("map<", "variant"))]
    return F.xxhash64(*(F.col(f"`{c}`") for c in plain))


def _ranges(rows: DataFrame, keys: list[str], rows_per_range: int) -> DataFrame | None:
    """Of each hot key its number of ranges and their bounds, in steps; None if no key is hot."""
    hot = written(rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_range), "hot")
    total = hot.agg(F.sum("_n")).first()[0]
    if not total:
        return None
    size = max(rows_per_range, -(-total // MOST_RANGES))
    hot = hot.filter(F.col("_n") > size).withColumn("_m", F.ceil(F.col("_n") / size).cast("long"))
    share = F.least(F.lit(1_000_000), F.ceil(F.col("_m") * SAMPLES * 1_000_000 / F.col("_n")))
    # Equal rows are sampled alike, so each counts once.
    picked = rows.join(F.broadcast(hot), keys).filter(F.pmod(F.xxhash64("_order"), F.lit(1_000_000)) < share).select(*keys, "_m", "_order").distinct()
    each = picked.groupBy(*keys, "_m").agg(F.sort_array(F.collect_list("_order")).alias("_all"))
    bound = lambda i: F.element_at("_all", (F.floor(i * F.size("_all") / F.col("_m")) + 1).cast("int"))
    bounds = F.when(F.col("_m") > 1, F.array_distinct(F.transform(F.sequence(F.lit(1).cast("long"), F.col("_m") - 1), bound)))
    blocks = F.transform(F.sequence(F.lit(1), F.size("_bounds"), F.lit(STEP)), lambda i: F.slice("_bounds", i, STEP))
    return written(each.withColumn("_bounds", bounds).filter(F.size("_bounds") > 0).select(*keys, blocks.alias("_blocks")), "ranges")


def _range_of(order: Column) -> Column:
    """How many bounds an order is at or past."""
    full = F.size(F.filter("_blocks", lambda b: b[0] <= order))
    within = F.size(F.filter(F.get("_blocks", full - 1), lambda x: x <= order))
    return F.when(F.col("_blocks").isNull() | (full == 0), F.lit(0)).otherwise((full - 1) * STEP + within)


def asof_join(
    left: DataFrame, right: DataFrame, by: list[str], at: str, ties: list[str] = (), other: str | None = None, strict: bool = False,
    within: Column | None = None, name: str = "match", rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Left rows with a struct ``name`` of the right row that they match, null if there is none.

    Both sides have the columns ``by`` and ``at``.  ``strict`` leaves out right rows of the very time;
    ``other`` names a column of both sides in which the match must differ from the left row (null being
    a value); ``within`` is the longest time between the two.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    whole = reduce(lambda a, c: a & F.col(f"`{c}`").isNotNull(), [*by, at], F.lit(True))
    named = [F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)]
    tie_kinds = [right.schema[c].dataType for c in ties]
    kind = F.col(f"`{other}`") if other else F.lit(None).cast("int")
    row = lambda df: F.struct(*(F.col(f"`{c}`") for c in df.columns))

    def order(side: int, tied: list[Column], last: Column) -> Column:
        return F.struct(F.col(f"`{at}`").alias("at"), F.lit(side).alias("side"), *(c.alias(f"t{i}") for i, c in enumerate(tied)), last.alias("last")).alias("_order")

    mine = left.filter(whole).select(*named, order(0 if strict else 1, [F.lit(None).cast(t) for t in tie_kinds], (F.rand(5) * (1 << 53)).cast("long")), row(left).alias("_left"), kind.alias("_own"))
    theirs = right.filter(whole).select(*named, order(1 if strict else 0, [F.col(f"`{c}`") for c in ties], _hashed(right)), F.struct(row(right).alias("_row"), kind.alias("_kind")).alias("_right"))
    rows = mine.unionByName(theirs, allowMissingColumns=True)
    ranges = _ranges(rows, keys, rows_per_range)
    if ranges is None:
        found = _states(rows, keys, ["_order"], other is not None).filter(F.col("_left").isNotNull())
        first, second = F.col("_s1"), F.col("_s2") if other else None
    else:
        part = [*keys, "_range"]
        cut = lambda df: df.join(F.broadcast(ranges), keys, "left").withColumn("_range", _range_of(F.col("_order"))).drop("_blocks")
        found = _states(cut(rows), part, ["_order"], other is not None).filter(F.col("_left").isNotNull())
        found = found.join(_carried(theirs, ranges, keys, other is not None), part, "left")
        first = F.coalesce("_s1", "_c1")
        if other:
            second = F.when(F.col("_s1").isNull(), F.col("_c2")).when(F.col("_s2").isNotNull(), F.col("_s2")).when(~F.col("_c1._kind").eqNullSafe(F.col("_s1._kind")), F.col("_c1")).otherwise(F.col("_c2"))
    match = F.when(first["_kind"].eqNullSafe(F.col("_own")), second).otherwise(first)["_row"] if other else first["_row"]
    if within is not None:
        match = F.when(F.col("_order.at") - match[at] <= within, match)
    out = found.select(F.col("_left.*"), match.alias(name))
    return out.unionByName(left.filter(~whole).withColumn(name, F.lit(None).cast(out.schema[name].dataType)))


def _carried(theirs: DataFrame, ranges: DataFrame, keys: list[str], other: bool) -> DataFrame:
    """What each range of a hot key begins with: the states ``_c1`` and ``_c2`` after all ranges before it."""
    part = [*keys, "_range"]
    hot = theirs.join(F.broadcast(ranges), keys).withColumn("_range", _range_of(F.col("_order"))).drop("_blocks")
    kinds = [F.col("_right._kind").alias("_kind")] if other else []
    lasts = hot.groupBy(*part, *kinds).agg(F.max_by("_right", "_order").alias("_right"), F.max("_order").alias("_order"))
    if other:
        lasts = lasts.withColumn("_at", F.row_number().over(Window.partitionBy(*part).orderBy(F.desc("_order")))).filter("_at <= 2").drop("_at", "_kind")
    bounds = F.size(F.flatten("_blocks"))
    begins = ranges.select(*keys, F.explode(F.sequence(F.lit(0), bounds)).alias("_range")).withColumn("_begins", F.lit(True))
    both = lasts.withColumn("_begins", F.lit(False)).unionByName(begins, allowMissingColumns=True)
    states = _states(both, keys, ["_range", F.desc("_begins"), "_order"], other).filter("_begins")
    return states.select(*part, F.col("_s1").alias("_c1"), *([F.col("_s2").alias("_c2")] if other else []))
