"""Stateful streams against tables: sessions with replays and late rows, retries with timers, over restarts."""

from __future__ import annotations

import json
import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators import retries as table_retries
from tidemill.operators import sessions as table_sessions
from tidemill.streaming import retries, sessions

T0 = datetime(2026, 1, 1)


def land(folder, batches, first=0):
    """One file of JSON lines a batch, read in the order of their times."""
    folder.mkdir(exist_ok=True)
    for i, rows in enumerate(batches, first):
        path = folder / f"{i:03d}.json"
        path.write_text("\n".join(json.dumps(r, default=str) for r in rows))
        stamp = time.time() - 1000 + i
        os.utime(path, (stamp, stamp))


def drain(spark, make, folder, schema, tmp_path):
    """Run over what is new in the folder: (rows so far, query)."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    q = make(stream).writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(200)
    return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())), q


def test_streamed_sessions_equal_those_of_the_table(spark, tmp_path):
    """Events out of order within the time allowed, some twice, and some that are too late."""
    rng = random.Random(3)
    events = [{"id": i, "user": rng.choice("abc"), "ts": T0 + timedelta(minutes=2 * i + rng.randint(0, 20)), "value": i % 9} for i in range(200)]
    batches = [events[a : a + 40] + events[max(a - 5, 0) : a] for a in range(0, 200, 40)]
    too_late = [{"id": 1000 + i, "user": "a", "ts": T0 + timedelta(minutes=i), "value": 1} for i in range(7)]
    batches[4] = batches[4] + too_late + too_late[:2]
    flush = {"id": 9999, "user": "z", "ts": T0 + timedelta(days=9), "value": 0}
    land(tmp_path / "in", batches[:3])
    schema = "id int, user string, ts timestamp, value int"
    gap = timedelta(minutes=7)
    make = lambda df: sessions.sessions(df, ["user"], "ts", gap, "45 minutes", {"n": F.count("*"), "total": F.sum("value")}, "id")
    listener = sessions.LateRows()
    spark.streams.addListener(listener)
    try:
        _, first = drain(spark, make, tmp_path / "in", schema, tmp_path)
        land(tmp_path / "in", [*batches[3:], [flush]], 3)
        got, second = drain(spark, make, tmp_path / "in", schema, tmp_path)
        until = time.time() + 30
        while not {str(first.runId), str(second.runId)} <= listener.ended and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    df = spark.createDataFrame([(e["id"], e["user"], e["ts"], e["value"]) for e in events], schema)
    want = table_sessions.sessions(df, ["user"], "ts", gap, {"n": ("count", None), "total": ("sum", "value")})
    assert got == sorted(map(tuple, want.collect()))
    assert sum(r[3] for r in got) == 200
    assert (listener.of(first), listener.of(second)) == (0, 9)


def test_a_gap_is_longer_than_nothing(spark):
    with pytest.raises(ValueError, match="longer than nothing"):
        sessions.sessions(spark.createDataFrame([(1, T0)], "id int, ts timestamp"), [], "ts", timedelta(0), "1 hour", {}, "id")


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, retries.PROVIDER)
    yield
    spark.conf.unset(key)


SCHEMA = "id string, at timestamp, ok boolean"


def test_retries_by_event_time_equal_those_of_the_table(spark, tmp_path, rocks):
    """Restarted in the middle; replays change nothing; a null outcome is a failure."""
    rng = random.Random(8)
    outcomes = [{"id": rng.choice("abcd"), "at": T0 + timedelta(minutes=11 * i), "ok": rng.choice([True, False, False, False, None])} for i in range(120)]
    outcomes.append({"id": "late", "at": T0 + timedelta(minutes=11 * 120), "ok": False})
    end = T0 + timedelta(days=9)
    batches = [outcomes[a : a + 31] for a in range(0, 121, 31)]
    batches[2] = batches[2] + batches[2][:6] + [{"id": None, "at": T0 + timedelta(minutes=11 * 90), "ok": False}]
    land(tmp_path / "in", batches[:2])
    make = lambda df: retries.retries(df, "id", by_clock=False)
    some, _ = drain(spark, make, tmp_path / "in", SCHEMA, tmp_path)
    land(tmp_path / "in", [*batches[2:], [{"id": "z", "at": end, "ok": True}]], 2)
    got, _ = drain(spark, make, tmp_path / "in", SCHEMA, tmp_path)
    df = spark.createDataFrame([(o["id"], o["at"], o["ok"]) for o in outcomes], SCHEMA)
    want = sorted(map(tuple, table_retries.orders(df, "id", F.lit(end)).collect()))
    assert got == want
    assert 0 < len(some) < len(got)
    assert {n for _, n, _ in got} >= {1, 2, 3}


def test_retries_by_the_clock_fall_due_while_nothing_arrives(spark, tmp_path, rocks):
    """A timer kept over a restart fires with no new outcome."""
    long_ago = datetime.now() - timedelta(hours=1)
    stream = lambda: retries.retries(spark.readStream.schema(SCHEMA).json(str(tmp_path / "in")), "id").writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    soon = datetime.now() - timedelta(minutes=15) + timedelta(seconds=25)
    land(tmp_path / "in", [[{"id": "old", "at": long_ago, "ok": False}, {"id": "soon", "at": soon, "ok": False}, {"id": "fine", "at": long_ago, "ok": True}]])
    for n in (1, 2):
        q = stream().trigger(processingTime="1 second").start()
        try:
            until = time.time() + 60
            while time.time() < until and (not (tmp_path / "out" / "_spark_metadata").exists() or spark.read.schema("id string, attempts int, due timestamp").parquet(str(tmp_path / "out")).count() < n):
                time.sleep(0.5)
        finally:
            q.stop()
    got = {r["id"]: (r["attempts"], r["due"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {"old", "soon"}
    assert got["soon"][0] == 1
    assert abs(got["soon"][1] - soon - timedelta(minutes=15)) < timedelta(milliseconds=2)


def test_pauses_of_columns_are_those_of_numbers(spark):
    df = spark.range(0, 40).select(F.col("id").cast("int").alias("n"), F.lit(T0).alias("at"))
    got = [r[0] for r in df.orderBy("n").select(table_retries.due(F.col("n"), F.col("at"))).collect()]
    assert got == [T0 + timedelta(minutes=table_retries.minutes(n)) for n in range(40)]
    assert [table_retries.minutes(n) for n in (0, 1, 2, 3, 7, 8, 99)] == [15, 15, 30, 60, 960, 1440, 1440]
