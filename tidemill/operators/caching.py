"""The scan cache: what earlier runs found, keyed by posting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``, which must be total within a key.

    As a maximum it is combined before the shuffle, so a key with very many rows is no burden.
    """
    rest = [c for c in df.columns if c not in keys]
    first = [*order, *(c for c in rest if c not in order)]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*first), F.struct(*order)).alias("_row"))
    return best.select(*(c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns))


def upsert(state: DataFrame, fresh: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The state with the fresh rows: the latest of each key wins."""
    return latest(state.unionByName(fresh), keys, order)


def evict(state: DataFrame, postings: DataFrame, keys: list[str]) -> DataFrame:
    """The state without the keys that are gone from the postings."""
    return state.join(postings.select(*keys).distinct(), keys, "left_semi")


def enrich(postings: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Every posting with what is known of it; null means not read yet."""
    return postings.join(state, keys, "left")
