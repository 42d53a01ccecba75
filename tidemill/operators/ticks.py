"""Times as whole numbers, and aggregates that can be merged."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How partial results of an aggregate become one.
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def ticks(df: DataFrame, at: str) -> Column:
    """A time as a bigint: microseconds of a timestamp, which for one without a zone do not depend on the session's; days of a date; else the number."""
    kind, c = dict(df.dtypes)[at], F.col(f"`{at}`")
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":
        micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
        minutes = F.unix_date(c.cast("date")).cast("bigint") * 1440 + F.hour(c) * 60 + F.minute(c)
        return minutes * 60_000_000 + micros
    return F.unix_date(c).cast("bigint") if kind == "date" else c.cast("bigint")


def length(span: timedelta | int) -> int:
    """A span of time in the unit of ``ticks``; it must be longer than nothing."""
    n = span // timedelta(microseconds=1) if isinstance(span, timedelta) else int(span)
    if n <= 0:
        raise ValueError("a span must be longer than nothing")
    return n


def block(at: str, size: int) -> Column:
    """The number of the block of ``size`` ticks that a time is in, also before zero."""
    return F.expr(f"({at} - pmod({at}, {size}L)) div {size}L")


def contribution(kind: str, value: Column | str | None) -> Column:
    """What one row adds to an aggregate of a column or expression; a count without one counts rows."""
    value = F.col(f"`{value}`") if isinstance(value, str) else value
    if kind not in MERGES:
        raise ValueError(f"{kind} can't be merged; there are {', '.join(MERGES)}")
    if kind == "count":
        return F.lit(1).cast("bigint") if value is None else F.when(value.isNotNull(), F.lit(1).cast("bigint"))
    return value


def combined(kind: str, a: Column, b: Column) -> Column:
    """Two partial results as one, null being nothing."""
    if kind in ("min", "max"):
        return (F.least if kind == "min" else F.greatest)(a, b)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
