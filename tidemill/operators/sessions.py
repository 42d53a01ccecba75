"""Sessions of a table: a key's rows that follow each other within a gap, as the streaming sessions have them.

Rows of a key within one block as long as the gap are of one session, so they are combined before the shuffle, however
many they are.  What is left of a key is joined within wider blocks; only the first and last session of such a
block can go on in another, and these alone meet by key.  So no task holds the rows of a hot key.

A row just one gap after the last still belongs to its session.  Rows without a time are of no session, those without a
key are a key's.  Aggregates leave out null values.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.ticks import MERGES, block, contribution, length, ticks
from tidemill.scratch import written

#: So many gaps make a wider block.
GAPS = 256


def _merged(kinds: list[str]) -> list[Column]:
    ends = [F.min("_a").alias("_a"), F.max("_z").alias("_z"), F.min("_start").alias("_start"), F.max("_last").alias("_last")]
    return ends + [MERGES[kind](f"_v{i}").alias(f"_v{i}") for i, kind in enumerate(kinds)]


def _chained(parts: DataFrame, keys: list[str], gap: int, kinds: list[str]) -> DataFrame:
    """Parts of sessions joined where one follows another within the gap, numbered ``_s`` from 1 in each group of ``keys``."""
    order = Window.partitionBy(*keys).orderBy("_a")
    begins = F.coalesce(F.col("_a") - F.lag("_z").over(order) > gap, F.lit(True))
    numbered = parts.withColumn("_begins", begins.cast("int")).withColumn("_s", F.sum("_begins").over(order))
    return numbered.groupBy(*keys, "_s").agg(*_merged(kinds))


def sessions(df: DataFrame, by: list[str], at: str, gap: timedelta | int, aggs: dict[str, tuple[str, Column | str | None]]) -> DataFrame:
    """(by, start, last, aggs): first and last time of each session and its aggregates (count, sum, min, max)."""
    size, kinds = length(gap), [kind for kind, _ in aggs.values()]
    keys = [f"_k{i}" for i in range(len(by))]
    values = [contribution(kind, value).alias(f"_v{i}") for i, (kind, value) in enumerate(aggs.values())]
    named = [F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)]
    timed = df.filter(F.col(f"`{at}`").isNotNull()).select(*named, ticks(df, at).alias("_a"), F.col(f"`{at}`").alias("_start"), *values)
    timed = timed.withColumns({"_z": F.col("_a"), "_last": F.col("_start"), "_block": block("_a", size)})
    parts = timed.groupBy(*keys, "_block").agg(*_merged(kinds)).withColumn("_wide", block("_block", GAPS))
    wide = [*keys, "_wide"]
    local = _chained(parts, wide, size, kinds)
    edge = (F.col("_s") == 1) | (F.col("_s") == F.max("_s").over(Window.partitionBy(*wide)))
    local = written(local.withColumn("_edge", edge), "sessions")
    columns = [*(F.col(k).alias(c) for c, k in zip(by, keys, strict=True)), F.col("_start").alias("start"), F.col("_last").alias("last"), *(F.col(f"_v{i}").alias(n) for i, n in enumerate(aggs))]
    met = _chained(local.filter("_edge"), keys, size, kinds) if keys else _chained(local.filter("_edge").withColumn("_k", F.lit(0)), ["_k"], size, kinds)
    out = local.filter("NOT _edge").select(*columns).unionByName(met.select(*columns))
    counts = [n for n, kind in zip(aggs, kinds, strict=True) if kind == "count"]
    return out.withColumns({n: F.coalesce(n, F.lit(0).cast("bigint")) for n in counts}) if counts else out
