"""Counted differences and subtotals: repeats, nulls, one scan."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from tidemill.operators import compacting


def test_counted_differences_equal_those_of_multisets(spark):
    rng = random.Random(4)
    lot = lambda n: [(rng.choice([1, 2, None]), rng.choice(["a", None])) for _ in range(n)]
    a, b = lot(60), [*lot(50), *[(9, "hot")] * 500]
    old, new = (spark.createDataFrame(x, "k int, v string") for x in (a, b))
    got = {(r["k"], r["v"]): (r["n_old"], r["n_new"]) for r in compacting.multiset_changes(old, new, ["k", "v"]).collect()}
    n, m = Counter(a), Counter(b)
    assert got == {x: (n[x], m[x]) for x in {*n, *m} if n[x] != m[x]}
    both = old.exceptAll(new).count() + new.exceptAll(old).count()
    assert both == sum(abs(x - y) for x, y in got.values())
    assert compacting.multiset_changes(old, old.repartition(3), ["k", "v"]).count() == 0
    assert compacting.multiset_changes(old.limit(0), new, ["k"]).agg(F.sum("n_new")).first()[0] == len(b)


def test_repeats_are_counted_before_the_shuffle(spark, capsys):
    df = spark.range(100).selectExpr("id % 2 AS k")
    compacting.multiset_changes(df, df, ["k"]).explain()
    plan = capsys.readouterr().out
    assert "partial_sum" in plan
    assert "Join" not in plan


def test_subtotals_are_told_from_nulls_and_need_one_scan(spark, tmp_path, capsys):
    rows = [("a", "x", 1), ("a", None, 2), (None, "x", 4), (None, None, 8)]
    spark.createDataFrame(rows, "g string, h string, n int").write.parquet(str(tmp_path / "t"))
    out = compacting.subtotals(spark.read.parquet(str(tmp_path / "t")), ["g", "h"], {"total": F.sum("n"), "rows": F.count("*")})
    got = {(r["g"], r["h"], r["level"]): (r["total"], r["rows"]) for r in out.collect()}
    assert got == {
        ("a", "x", 0): (1, 1), ("a", None, 0): (2, 1), (None, "x", 0): (4, 1), (None, None, 0): (8, 1),
        ("a", None, 1): (3, 2), (None, None, 1): (12, 2), (None, "x", 2): (5, 2), (None, None, 2): (10, 2), (None, None, 3): (15, 4),
    }
    out.explain()
    assert capsys.readouterr().out.split("Initial Plan")[0].count("FileScan") == 1
