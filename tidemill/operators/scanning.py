"""What is read in a run, and what reading finds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import rules
from tidemill.scratch import written


def unread(postings: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Postings that the state does not know by all of ``keys``."""
    return postings.join(state.select(*keys).distinct(), keys, "left_anti")


def slice_of(postings: DataFrame, state: DataFrame, keys: list[str], budget: int, order: list[Column]) -> DataFrame:
    """The next ``budget`` unread postings; ``order`` must be total for the choice to be repeatable."""
    return unread(postings, state, keys).orderBy(*order).limit(budget)


def ranked(df: DataFrame, order: list[str] | list[Column], name: str) -> DataFrame:
    """Add the row's number from 1 in the order of all rows.

    Rows are dealt into ranges and numbered within them; where a range begins follows from the
    counts of those before it.  So no task orders all rows, as one window over them would.
    """
    dealt = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_own", own).join(starts, "_range").withColumn(name, F.col("_own") + F.col("_start")).drop("_range", "_own", "_start")


def schedule(postings: DataFrame, state: DataFrame, keys: list[str], budget: int, order: list[str]) -> DataFrame:
    """Every unread posting with the number of the run that will read it, from 1."""
    return ranked(unread(postings, state, keys), order, "_rank").withColumn("run", F.floor((F.col("_rank") + budget - 1) / budget).cast("long")).drop("_rank")


def with_evidence(df: DataFrame, text: str, used: tuple[rules.Rule, ...]) -> DataFrame:
    """Add ``evidence``, the names of the rules that find something, ``_low`` and ``_clauses``, the folded text and its clauses.

    These are columns of their own, so that each is made once a text, by compiled code.
    """
    df = df.withColumn("_low", rules.folded(F.col(text)))
    df = df.withColumn("_clauses", rules.clauses(F.col("_low"), used, rules.MONEY_NEEDS))
    return df.withColumn("evidence", F.when(F.col(text).isNotNull(), rules.evidence(F.col(text), F.col("_low"), F.col("_clauses"), used)))


def findings(postings: DataFrame, text: str = "text", used: tuple[rules.Rule, ...] = rules.RULES) -> DataFrame:
    """Add what the rules find: null only where there is no text to read.

    The rules are tried once; flags follow from the names of those that find something, ``spans`` says where first.
    """
    read = with_evidence(postings, text, used)
    spans = F.when(F.size("evidence") > 0, rules.spans(F.col("evidence"), F.col("_low"), F.col("_clauses"), used)).when(F.col("evidence").isNotNull(), F.array().cast(T.ArrayType(rules.SPAN)))
    read = read.withColumns({"rules_version": F.lit(rules.version(used)), "pay": rules.pay(F.col("_low"), F.col("_clauses")), "spans": spans}).drop("_low", "_clauses")
    flag = lambda kind: F.coalesce(rules.of_kind(F.col("evidence"), kind, used), F.when(F.col("evidence").isNotNull(), F.lit(False)))
    return read.withColumns({"sponsorship_barrier": flag("barrier"), "agent_directed": flag("agent")})
