"""Sketches that are stored a run at a time and merged over runs: distinct counts and quantiles.

Every run stores its own bins' sketches in a folder of its name, so a run that is repeated replaces what it stored.  A
report over any time merges stored sketches, a few kilobytes a group and bin, and reads no row again.
An id seen in several bins or runs counts once; rows that a run repeats under another name count twice in ``n`` and in
the quantiles, though not in the distinct count.

Nulls: a null id is not counted, a null value has no rank; a group of nothing else has 0 ids and null quantiles, and ``n``
counts rows that have a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: 2^LOG_BINS registers of a distinct count, whose standard error that is; size of a quantile sketch, about 1.7 % of ranks.
LOG_BINS = 12
DISTINCT_ERROR = 1.04 / (1 << LOG_BINS) ** 0.5
QUANTILE_SIZE = 200


def sketched(df: DataFrame, by: list[str], key: str, value: str) -> DataFrame:
    """(by, ids, ranks): of each group a sketch of its distinct keys and one of its values, combined before the shuffle."""
    text = F.col(key).cast("string")
    return df.groupBy(*by).agg(F.hll_sketch_agg(text, LOG_BINS).alias("ids"), F.kll_sketch_agg_double(F.col(value).cast("double"), QUANTILE_SIZE).alias("ranks"))


def merged(kept: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of wider groups out of those of narrower ones."""
    return kept.groupBy(*by).agg(F.hll_union_agg("ids").alias("ids"), F.kll_merge_agg_double("ranks", QUANTILE_SIZE).alias("ranks"))


def estimates(kept: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """(others, n, n_distinct, quantiles): what the sketches tell; ``n`` is exact."""
    n = F.kll_sketch_get_n_double("ranks")
    at = lambda q: F.when(n > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(q)))
    columns: list[Column] = [F.col(f"`{c}`") for c in kept.columns if c not in ("ids", "ranks")]
    return kept.select(*columns, n.alias("n"), F.hll_sketch_estimate("ids").alias("n_distinct"), *(at(q).alias(name) for name, q in quantiles.items()))


def store(kept: DataFrame, root: str, run: str) -> None:
    """Store a run's sketches in place of what it stored before."""
    kept.write.mode("overwrite").parquet(f"{root.rstrip('/')}/run={run}")


def stored(spark: SparkSession, root: str) -> DataFrame:
    """All runs' sketches, with ``run``."""
    return spark.read.parquet(root)
