"""Sessions of a stream, each event once, and how many events came too late for them.

On tables ``operators.sessions`` gives the same rows; here a session is given once no event can extend it any more.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener


def sessions(events: DataFrame, by: list[str], at: str, gap: timedelta, late: str, aggs: dict[str, Column], id: str) -> DataFrame:
    """(by, start, last, aggs) of a stream; an event more than ``late`` behind the newest one is dropped and counted.

    An event whose ``id`` was seen within that time is a replay and left out.
    """
    seconds = gap.total_seconds()
    if seconds <= 0:
        raise ValueError("a gap must be longer than nothing")
    timed = events.withColumn(at, F.col(f"`{at}`").cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([id])
    window = F.session_window(at, f"{round(seconds * 1_000_000)} microseconds").alias("_w")
    found = timed.groupBy(*by, window).agg(*(c.alias(n) for n, c in aggs.items()))
    last = F.timestamp_micros(F.unix_micros("_w.end") - round(seconds * 1_000_000))
    return found.select(*by, F.col("_w.start").alias("start"), last.alias("last"), *aggs)


class LateRows(StreamingQueryListener):
    """Counts the events that each query dropped as too late, over all its batches; add it to ``spark.streams``.

    Exact for ``sessions``: its first operator drops single events, so none is late in the next.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self.dropped[str(event.runId)] = 0

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        run = str(event.progress.runId)
        self.dropped[run] = self.dropped.get(run, 0) + sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self.ended.add(str(event.runId))

    def of(self, query: StreamingQuery) -> int:
        return self.dropped.get(str(query.runId), 0)
