"""A training corpus from documents: five stages, each written as Parquet and read again by the next.

Every stage takes nulls in any column, empty and very long texts, ties, repeated rows, empty tables
and further columns.  A null text counts as empty: it is scored as such, is one empty line, is near
nothing, has no words and packs as its end token.  A null id comes before all others, and rows of
one id are one document where documents are compared: they stay or go together, unless the scores
of their texts differ, and share the copies that the mix takes of them evenly, rounded.  Otherwise
rows are treated each for itself.  Further columns stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill import scratch
from tidemill.llm import line_dedup, mixing, near_dedup, quality, queries

SCORE = "__tidemill_score"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    model = quality.learn(docs, queries.table(spark, sf_dir, "labels"), "quality", queries.fold() != 0)
    return quality.score(docs, model, SCORE).filter(F.col(SCORE) >= queries.QUALITY_KEEP).select(*docs.columns)


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep repeated lines only in their first document; a document that has no other lines stays, empty."""
    # Columns that are named like those that it adds are kept under other names meanwhile.
    aside = {c: f"__tidemill_{c}" for c in docs.columns if c.lower() in ("n_lines", "n_dropped")}
    out = line_dedup.dedup_lines(docs.withColumnsRenamed(aside)).drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in aside.items()})
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near duplicates."""
    found = near_dedup.near_duplicates(docs)
    gone = scratch.written(found.filter(~F.col("kept")).select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come near their target shares."""
    copies = scratch.written(mixing.mix(docs).select("doc_id", "copies"), "copies")
    return mixing.repeated(docs, copies)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the documents' token pieces into sequences of at most 1024 tokens."""
    return queries.packed_digest(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", first_lines),
    ("near-dedup", one_of_each),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

#: SQL can't fit the classifier, tokenise or pack; the tests follow the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of ``sf_dir``; only the last one's table stays."""
    docs, since = queries.table(spark, sf_dir, "documents"), scratch.mark()
    for name, stage in STAGES:
        docs = scratch.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.release(spark, since)
    return docs
