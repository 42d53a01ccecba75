"""As-of joins against plain loops: ties, nulls, other kinds, hot keys cut at any place."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators import asof


def plain(left, right, strict=False, other=False, within=None):
    """The tie-breaker of the match of each left row (id, key, at, kind), by looking at all."""
    out = {}
    for i, k, at, kind in left:
        fits = [r for r in right if k is not None and at is not None and r[1] == k and r[2] is not None and (r[2] < at or (r[2] == at and not strict)) and not (other and r[3] == kind)]
        best = max(fits, key=lambda r: (r[2], r[0]), default=None)
        out[i] = best[0] if best and (within is None or at - best[2] <= within) else None
    return out


def rows(n, seed, first=0):
    rng = random.Random(seed)
    return [(first + i, rng.choice([1, 1, 1, 1, 2, 3, None]), rng.choice([None, *range(200)]), rng.choice(["a", "b", "b", "b", None])) for i in range(n)]


SCHEMA = "id int, k int, at int, kind string"


@pytest.mark.parametrize(("rows_per_range", "strict", "other"), [(10**6, False, True), (10**6, True, False), (1, True, True), (7, False, False), (7, False, True), (100, True, True)])
def test_equals_a_plain_loop(spark, rows_per_range, strict, other):
    a, b = rows(300, 1), rows(250, 2, 1000)
    left, right = spark.createDataFrame(a, SCHEMA).repartition(5), spark.createDataFrame(b, SCHEMA).repartition(3)
    out = asof.asof_join(left, right, ["k"], "at", ["id"], "kind" if other else None, strict, rows_per_range=rows_per_range)
    assert out.columns == ["id", "k", "at", "kind", "match"]
    got = out.collect()
    assert len(got) == 300
    assert {r["id"]: r["match"] and r["match"]["id"] for r in got} == plain(a, b, strict, other)


def test_long_runs_of_one_kind_reach_over_ranges(spark):
    """The last of another kind may lie many ranges back."""
    b = [(i, 1, i, "b" if i == 3 else "a") for i in range(400)]
    df = spark.createDataFrame(b, SCHEMA)
    got = asof.asof_join(df, df, ["k"], "at", ["id"], "kind", strict=True, rows_per_range=10).collect()
    assert {r["id"]: r["match"] and r["match"]["id"] for r in got} == plain(b, b, True, True)


def test_tolerance_and_several_keys(spark):
    a, b = rows(200, 3), rows(60, 4, 1000)
    left = spark.createDataFrame(a, SCHEMA).withColumn("part", F.lit("x"))
    right = spark.createDataFrame(b, SCHEMA).withColumn("part", F.lit("x"))
    got = asof.asof_join(left, right, ["part", "k"], "at", ["id"], within=F.lit(4), name="m").collect()
    assert {r["id"]: r["m"] and r["m"]["id"] for r in got} == plain(a, b, within=4)
    assert asof.asof_join(left, right.withColumn("part", F.lit("y")), ["part", "k"], "at").filter("match is not null").count() == 0


def test_timestamps_empty_sides_and_repeated_rows(spark):
    t = datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, t), (1, t), (1, t + timedelta(hours=1)), (2, t)], "k int, at timestamp")
    right = spark.createDataFrame([(1, t, {"a": 1}), (1, t + timedelta(minutes=30), {"b": 2})], "k int, at timestamp, props map<string,int>")
    for size in (1, 100):
        got = sorted((r["k"], r["at"], r["match"] and r["match"]["at"]) for r in asof.asof_join(left, right, ["k"], "at", rows_per_range=size).collect() if r["k"] == 1)
        assert got == [(1, t, t), (1, t, t), (1, t + timedelta(hours=1), t + timedelta(minutes=30))]
    assert asof.asof_join(left.limit(0), right, ["k"], "at").count() == 0
    assert asof.asof_join(left, right.limit(0), ["k"], "at").filter("match is null").count() == 4


def test_a_hot_key_is_cut_into_even_ranges(spark):
    df = spark.range(20_000).select((F.col("id") % 2 * F.col("id")).alias("k"), F.col("id").alias("at"), F.struct(F.col("id").alias("at")).alias("_order"))
    ranges = asof._ranges(df.withColumnRenamed("k", "_k0"), ["_k0"], 1000)
    cut = df.withColumnRenamed("k", "_k0").join(ranges, "_k0", "left").withColumn("_range", asof._range_of(F.col("_order"))).filter("_k0 = 0")
    sizes = [r["count"] for r in cut.groupBy("_range").count().collect()]
    assert sum(sizes) == 10_000
    assert len(sizes) == 10
    assert max(sizes) < 2000


def test_nothing_is_joined_by_an_inequality(spark, capsys):
    df = spark.createDataFrame(rows(50, 5), SCHEMA)
    asof.asof_join(df, df, ["k"], "at", ["id"], rows_per_range=5).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan
    assert "Cartesian" not in plan
