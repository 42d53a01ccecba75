"""Retries as keyed state with timers: each key's failures in a row, and a timer for when it is due again.

State and timers are in the checkpoint, so a restart goes on where the last run ended.  By event time a
retry falls due as the watermark passes it, which makes a replay repeatable; by processing time it does so
by the clock, also while nothing arrives, and state that is not touched for ``TTL_DAYS`` goes; such a query
stays resident, as one that drains what is there (``availableNow``) would wait for its timers for ever.
Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tidemill.operators.retries import minutes

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TTL_DAYS = 60


class _Retries(StatefulProcessor):
    def __init__(self, ttl_ms: int | None) -> None:
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        #: Failures in a row, the last outcome's time, and when the retry is due; 0 once it was ordered or is not wanted.
        self._state = handle.getValueState("failures", "attempts int, at bigint, due bigint", self._ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        attempts, last, due = self._state.get() if self._state.exists() else (0, None, 0)
        armed = due
        outcomes: dict[int, bool] = {}
        for r in rows:
            outcomes[r["ms"]] = outcomes.get(r["ms"], False) or bool(r["ok"])
        for at, ok in sorted(outcomes.items()):
            if last is not None and at <= last:
                continue  # known already, or overtaken
            if due and due < at:
                yield self._order(key, attempts, due)
            attempts, last = (0 if ok else attempts + 1), at
            due = 0 if ok else at + minutes(attempts) * 60_000
        if armed and armed != due:
            self._handle.deleteTimer(armed)
        if due and due != armed:
            self._handle.registerTimer(due)
        if last is not None:
            self._state.update((attempts, last, due))

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        if self._state.exists():
            attempts, last, due = self._state.get()
            if due == expiredTimerInfo.getExpiryTimeInMs():
                self._state.update((attempts, last, 0))
                yield self._order(key, attempts, due)

    def close(self) -> None:
        pass

    @staticmethod
    def _order(key: Any, attempts: int, due: int) -> Row:
        return Row(key=str(key[0]), attempts=attempts, due=datetime.fromtimestamp(due / 1000, UTC))


def retries(outcomes: DataFrame, key: str, by_clock: bool = True, late: str = "0 seconds") -> DataFrame:
    """(key, attempts, due): a row for each retry as it falls due, from a stream of (key, at, ok).

    Times count in milliseconds.  Rows without a key or time are none, a null ``ok`` is a failure.  An outcome
    older than the last known one of its key is left out.
    """
    known = outcomes.filter(F.col(key).isNotNull() & F.col("at").isNotNull()).withColumn("at", F.col("at").cast("timestamp"))
    if not by_clock:
        known = known.withWatermark("at", late)
    timed = known.select(F.col(key).cast("string").alias("key"), "at", F.unix_millis("at").alias("ms"), "ok").groupBy("key")
    mode, ttl = ("ProcessingTime", TTL_DAYS * 86_400_000) if by_clock else ("EventTime", None)
    out = timed.transformWithState(_Retries(ttl), "key string, attempts int, due timestamp", "append", mode)
    return out.select(F.col("key").alias(key), "attempts", "due")
