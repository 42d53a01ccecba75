"""Gapless numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: About so many rows are numbered by one task; larger groups are salted.
ROWS_PER_SALT = 50_000


def numbered(df: DataFrame, by: list[str], order: list[str], salt_on: list[str], salts: Column, name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... within each group of the columns ``by``, which hold no nulls.

    A group is split by a hash into ``salts`` parts, which are numbered apart; the parts' counts,
    a few numbers, give where each begins.  ``df`` is read twice, so it should be a written table.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), salts.cast("long")))
    keys = [*by, "_salt"]
    before = Window.partitionBy(*by).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = salted.groupBy(*keys).agg(F.count("*").alias("_n")).select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return salted.withColumn("_own", own).join(starts, keys).withColumn(name, (F.col("_own") + F.col("_start")).cast("long")).drop("_own", "_start", "_salt")
