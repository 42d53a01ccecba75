"""Interval joins against plain loops: any lengths, points, empty and backward spans, nulls, keys."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tidemill.operators import intervals


def spans(n, seed, longest):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = rng.randint(-500, 5000)
        out.append((i, rng.choice([1, 1, 2, None]), a if rng.random() > 0.05 else None, a + rng.choice([0, -3, 1, 1, 2, rng.randint(1, 30), rng.randint(1, longest)])))
    return out


def plain(left, right, by):
    real = lambda s: s[2] is not None and s[3] > s[2] and (not by or s[1] is not None)
    return Counter((x[0], y[0]) for x in left if real(x) for y in right if real(y) and x[2] < y[3] and y[2] < x[3] and (not by or x[1] == y[1]))


SCHEMA = "id int, k int, a long, z long"


@pytest.mark.parametrize(("width", "by"), [(1, []), (10, ["k"]), (1000, [])])
def test_equals_a_plain_loop(spark, width, by):
    a, b = spans(150, 1, 3000), spans(120, 2, 300)
    a, b = a + a[:5], b + b[:3]
    out = intervals.interval_join(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), ("a", "z"), ("a", "z"), width, by)
    assert out.columns == ["left", "right"]
    assert Counter((r["left"]["id"], r["right"]["id"]) for r in out.collect()) == plain(a, b, by)


def test_spans_are_copied_a_few_times_however_long(spark):
    df = spark.createDataFrame([(i, 1, 0, 10**i) for i in range(1, 15)], SCHEMA)
    levelled = intervals._levelled(df, "a", "z", [], 1, "_left")
    from pyspark.sql import functions as F

    assert intervals._bins(levelled, F.array("_level"), 1).count() <= 2 * 14


def test_times_are_spans_too(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS a, TIMESTAMP '2024-01-01 01:30:00' AS z")
    later = spark.sql("SELECT TIMESTAMP '2024-01-01 01:29:59' AS a, TIMESTAMP '2024-01-01 01:30:00' AS z UNION ALL SELECT TIMESTAMP '2024-01-01 01:30:00', TIMESTAMP '2024-01-01 02:30:00'")
    assert intervals.interval_join(df, later, ("a", "z"), ("a", "z"), 5400).count() == 1


def test_empty_sides_and_no_nested_loop(spark, capsys):
    df = spark.createDataFrame(spans(20, 3, 100), SCHEMA)
    assert intervals.interval_join(df.limit(0), df, ("a", "z"), ("a", "z"), 10).count() == 0
    assert intervals.interval_join(df, df.limit(0), ("a", "z"), ("a", "z"), 10).count() == 0
    intervals.interval_join(df, df, ("a", "z"), ("a", "z"), 10).explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan
    assert "Cartesian" not in plan
