"""Interval join: pairs of rows whose spans of time (or of any whole numbers) overlap.

Every span belongs to a level by its length: at level ``k`` a bin is ``width * 2**k`` long and a span of the
level touches two of them at most, whatever its length.  Two spans meet at the higher of their
levels, by an equi-join on bins, and count as a pair in the first bin that both touch, so once.  A
span is copied only to levels that the other side has, a few rows each; nothing is compared by an
inequality but within a bin.

Spans are half open: from ``start`` up to, not including, ``end``.  An empty or backward span touches
nothing, and neither does one with a null end or key.  Equal rows pair each for itself.  A bin in which very many
spans of both sides overlap has that many results; its join is split by the adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 40


def _levelled(df: DataFrame, start: str, end: str, by: list[str], width: int, row: str) -> DataFrame:
    """(keys, _a, _z, _level, row): the ends of each span that is one, the last within it, and its level."""
    a, z = F.col(start).cast("bigint"), F.col(end).cast("bigint") - 1
    level = F.greatest(F.lit(0), F.ceil(F.log2((z - a + 1).cast("double") / width))).cast("int")
    known = [F.col(f"`{c}`").isNotNull() for c in by]
    spans = df.filter(z >= a)
    for k in known:
        spans = spans.filter(k)
    return spans.select(*(F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(by)), a.alias("_a"), z.alias("_z"), level.alias("_level"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(row))


def _bins(spans: DataFrame, levels: Column, width: int) -> DataFrame:
    """A row for each bin that a span touches at each of the levels."""
    at = spans.withColumn("_met", F.explode(levels)).withColumn("_size", F.expr(f"shiftleft({width}L, _met)"))
    low, high = (F.floor(F.col(c) / F.col("_size")).cast("bigint") for c in ("_a", "_z"))
    return at.withColumns({"_first": low, "_bin": F.explode(F.sequence(low, high))}).drop("_size")


def interval_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], width: int, by: list[str] = ()) -> DataFrame:
    """(left, right): two structs of the rows of each overlapping pair with equal ``by``.

    Ends are columns of whole numbers, or expressions that a cast to bigint understands; ``width``, in
    their unit, is best about the length of the usual span.
    """
    ours, theirs = _levelled(left, *left_span, list(by), width, "_left"), _levelled(right, *right_span, list(by), width, "_right")
    of = lambda x: sorted(r[0] for r in x.select("_level").distinct().collect())
    a, b = of(ours), of(theirs)  # at most LEVELS numbers each
    keys = [f"_k{i}" for i in range(len(by))]
    higher = lambda levels: F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda m: m > F.col("_level"))
    own = F.array("_level")

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        y = y.withColumnsRenamed({c: f"{c}2" for c in ("_a", "_z", "_level", "_first")})
        both = x.join(y, [*keys, "_met", "_bin"])
        return both.filter((F.col("_bin") == F.greatest("_first", "_first2")) & (F.col("_a") <= F.col("_z2")) & (F.col("_a2") <= F.col("_z"))).select(F.col("_left").alias("left"), F.col("_right").alias("right"))

    # At its own level a span meets those of this level and, of the other side, those that are lifted to it.
    level, lifted = _bins(ours, own, width), _bins(ours, higher(b), width)
    return met(level, _bins(theirs, F.concat(own, higher(a)), width)).unionByName(met(lifted, _bins(theirs, own, width)))
