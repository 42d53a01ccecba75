"""Stored sketches: within their stated errors of exact counts, merged over runs, repeated runs replaced."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import sketches


def table(spark, first, n):
    return spark.range(first, first + n).select((F.col("id") % 7).alias("g"), F.concat(F.lit("p"), "id").alias("key"), F.col("id").cast("double").alias("value"))


def test_runs_merge_within_the_stated_errors(spark, tmp_path):
    root = str(tmp_path / "kept")
    for run, first in enumerate((0, 20_000, 40_000)):  # ids 20,000 to 29,999 and 40,000 to 49,999 are in two runs
        sketches.store(sketches.sketched(table(spark, first, 30_000), ["g"], "key", "value"), root, f"{run:03d}")
    sketches.store(sketches.sketched(table(spark, 40_000, 30_000), ["g"], "key", "value"), root, "002")
    kept = sketches.stored(spark, root)
    assert kept.count() == 21
    (whole,) = sketches.estimates(sketches.merged(kept, []), {"q1": 0.25, "q9": 0.9}).collect()
    assert whole["n"] == 90_000
    assert abs(whole["n_distinct"] - 70_000) <= 3 * sketches.DISTINCT_ERROR * 70_000
    rank = lambda x: sum(min(max(x - a, 0), 30_000) for a in (0, 20_000, 40_000)) / 90_000
    assert abs(rank(whole["q1"]) - 0.25) < 0.03
    assert abs(rank(whole["q9"]) - 0.9) < 0.03
    each = sketches.estimates(sketches.merged(kept, ["g"]), {}).collect()
    assert {r["g"] for r in each} == set(range(7))
    assert all(abs(r["n_distinct"] - 10_000) <= 4 * sketches.DISTINCT_ERROR * 10_000 for r in each)


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (2, "a", 3.0), (2, "a", None)], "g int, key string, value double")
    out = sketches.estimates(sketches.merged(sketches.sketched(df, ["g"], "key", "value"), ["g"]), {"middle": 0.5}).orderBy("g").collect()
    assert [tuple(r) for r in out] == [(1, 0, 0, None), (2, 1, 1, 3.0)]
    assert sketches.merged(sketches.sketched(df.limit(0), ["g"], "key", "value"), ["g"]).count() == 0


def test_rows_are_combined_before_the_shuffle(spark, capsys):
    sketches.sketched(table(spark, 0, 10), ["g"], "key", "value").explain()
    assert "partial_hll_sketch_agg" in capsys.readouterr().out
