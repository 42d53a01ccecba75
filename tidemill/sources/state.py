"""The scan cache as versioned Parquet tables: a new version is written whole, then pointed to.

A version that a reader holds is never touched, so reading a version while the next is written is
safe, and a run that dies in between leaves the old one in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemill.functions.rules import PAY_TYPE
from tidemill.sources import files

STATE = T.StructType(
    [
        T.StructField("posting_id", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("rules_version", T.StringType()),
        T.StructField("scanned_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("sponsorship_barrier", T.BooleanType()),
        T.StructField("agent_directed", T.BooleanType()),
        T.StructField("pay", PAY_TYPE),
        T.StructField("evidence", T.ArrayType(T.StringType())),
    ]
)
POINTER, KEEP = "CURRENT", 3


def current(spark: SparkSession, root: str) -> str | None:
    """The version pointed to, or null before the first."""
    found = files.read_text(spark, f"{root}/{POINTER}")
    return found.strip() if found else None


def load(spark: SparkSession, root: str, schema: T.StructType = STATE) -> DataFrame:
    """The current state; without one, an empty table, so that everything is read anew over the next runs."""
    version = current(spark, root)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{version}")


def save(df: DataFrame, root: str) -> str:
    """Write the next version, point to it, and forget all but the last ``KEEP``."""
    spark = df.sparkSession
    last = current(spark, root)
    version = f"v{(int(last[1:]) if last else 0) + 1:09d}"
    files.delete(spark, f"{root}/{version}")  # of a run that died before it moved the pointer
    df.write.parquet(f"{root}/{version}")
    files.write_text(spark, f"{root}/{POINTER}", version)
    for old in [n for n in files.names(spark, root) if n.startswith("v") and n < version][: -KEEP + 1 or None]:
        files.delete(spark, f"{root}/{old}")
    return version
