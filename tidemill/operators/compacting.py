"""The small result that is published, and whether it changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_exact(df: DataFrame, text: str, key: str) -> DataFrame:
    """(digest, keeper, copies): the smallest key of each text and how many rows hold it."""
    return df.groupBy(F.md5(text).alias("digest")).agg(F.min(key).alias("keeper"), F.count("*").alias("copies"))


def as_json(columns: list[str]) -> Column:
    """The columns as one JSON object; nulls are written, as they mean not read yet."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row (n_rows, fingerprint) that tells whether two tables hold the same rows, in any order.

    Each row's digest is cut into four words, and their sums are digested: so tasks combine sums
    instead of gathering every row's digest in one place.
    """
    digest = F.md5(as_json(columns))
    words = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("decimal(20,0)") for k in range(4)]
    sums = df.agg(F.count("*").alias("n_rows"), *(F.coalesce(F.sum(w), F.lit(0)).cast("decimal(30,0)").cast("string").alias(f"_{k}") for k, w in enumerate(words)))
    return sums.select("n_rows", F.sha2(F.concat_ws(":", "n_rows", "_0", "_1", "_2", "_3"), 256).alias("fingerprint"))


def changes(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, change): rows added, removed or changed between two snapshots with unique keys."""
    a = old.select(*keys, F.struct(*columns).alias("_old"), F.lit(True).alias("_in_old"))
    b = new.select(*keys, F.struct(*columns).alias("_new"), F.lit(True).alias("_in_new"))
    both = a.join(b, keys, "full")
    same = reduce(lambda x, c: x & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), columns, F.lit(True))
    change = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(~same, "changed")
    return both.withColumn("change", change).filter("change is not null").select(*keys, "change")


def multiset_changes(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, n_old, n_new): the rows that two tables hold unequally often, and how often each does.

    Rows need no key and may repeat; nulls equal each other.  Repeats are counted before the shuffle, so a row
    that makes up most of a table is one row of it.
    """
    side = lambda df, a, b: df.select(*columns, F.lit(a).cast("bigint").alias("_old"), F.lit(b).cast("bigint").alias("_new"))
    counted = side(old, 1, 0).unionByName(side(new, 0, 1)).groupBy(*columns).agg(F.sum("_old").alias("n_old"), F.sum("_new").alias("n_new"))
    return counted.filter("n_old <> n_new")


def subtotals(df: DataFrame, by: list[str], sums: dict[str, Column]) -> DataFrame:
    """Aggregates for every combination of ``by``, down to the total, from one scan.

    ``level`` has a bit for each column of ``by``, the first the highest, that is set where the row sums over
    it: so a subtotal is told from a group of nulls.  ``df`` should hold only what the aggregates need, as
    each of its rows is summed once a combination.
    """
    return df.cube(*by).agg(F.grouping_id().alias("level"), *(c.alias(n) for n, c in sums.items()))
