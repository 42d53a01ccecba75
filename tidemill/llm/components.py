"""Connected components of a graph given by its links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.scratch import written

ROUNDS = 100


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(v, component): for every end of a link the smallest vertex that it reaches.

    Each round every vertex sends its larger neighbours (large star), then its smaller ones and
    itself (small star), to the smallest it knows.  Only counts and a checksum reach the driver.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges, last = written(edges, "edges"), None
    for _ in range(ROUNDS):
        seen = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == last or not seen[0]:
            ends = edges.select(F.col("u").alias("v"), F.col("v").alias("component")).unionByName(edges.select("v", F.col("v").alias("component")))
            return written(ends.distinct(), "components")
        last = seen
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that a join by a vertex of very many neighbours can be split or broadcast.
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = written(large, "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = written(small.filter("u <> v").distinct(), "edges")
    raise RuntimeError("components did not settle")
