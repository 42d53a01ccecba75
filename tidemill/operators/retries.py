"""When a failed reading is tried again: after a pause that doubles each time, up to a day, and never given up.

``orders`` says over a table of outcomes what ``streaming.retries`` says as time goes by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST_MINUTES, LONGEST_MINUTES = 15, 24 * 60
#: From so many doublings on, a pause is the longest.
DOUBLINGS = 7


def minutes(attempts: int) -> int:
    """The pause after so many failures in a row."""
    return min(LONGEST_MINUTES, FIRST_MINUTES << min(max(attempts - 1, 0), DOUBLINGS))


def due(attempts: Column, at: Column) -> Column:
    """When what failed last ``at``, for so many times in a row, is to be tried again."""
    pauses = F.array(*(F.lit(minutes(n + 1)) for n in range(DOUBLINGS + 1)))
    pause = F.element_at(pauses, F.least(F.greatest(attempts, F.lit(1)), F.lit(DOUBLINGS + 1)).cast("int"))
    return at + F.make_dt_interval(F.lit(0), F.lit(0), pause)


def orders(outcomes: DataFrame, key: str, until: Column) -> DataFrame:
    """(key, attempts, due): each retry that falls due before ``until`` out of (key, at, ok), failures in a row counted.

    A retry that another outcome comes before, or just as it falls due, is not wanted any more.  Outcomes without
    a key or time are none, a null ``ok`` is a failure; of several at one time it is a success if any is.
    """
    known = outcomes.filter(F.col(key).isNotNull() & F.col("at").isNotNull())
    each = known.groupBy(key, "at").agg(F.max(F.coalesce("ok", F.lit(False))).alias("ok"))
    order = Window.partitionBy(key).orderBy("at")
    runs = each.withColumns({"_run": F.count_if("ok").over(order), "_next": F.lead("at").over(order)}).filter("NOT ok")
    failed = runs.withColumn("attempts", F.row_number().over(Window.partitionBy(key, "_run").orderBy("at"))).withColumn("due", due(F.col("attempts"), F.col("at")))
    return failed.filter((F.col("due") < F.col("_next")) | (F.col("_next").isNull() & (F.col("due") < until))).select(key, "attempts", "due")
