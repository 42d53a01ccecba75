from __future__ import annotations

import os
import threading

import pytest

from tidemill import scratch


def test_tables_are_written_to_the_shared_folder_and_released(spark):
    at = scratch.shared_dir(spark).removeprefix("file:")
    since = scratch.mark()
    a, b = scratch.written(spark.range(3), "a"), scratch.written(spark.range(5), "b")
    assert (a.count(), b.count()) == (3, 5)
    scratch.release(spark, since)
    assert b.count() == 5
    assert not [f for f in os.listdir(at) if f.startswith("tidemill-a-")]


def test_threads_do_not_touch_each_others_tables(spark):
    """Two runs at once: one ends and releases all of its own while the other still reads."""
    written, released, seen = threading.Event(), threading.Event(), []

    def one():
        since = scratch.mark()
        table = scratch.written(spark.range(7), "one")
        written.set()
        released.wait(60)
        seen.append(table.count())
        scratch.release(spark, since, keep=0)

    thread = threading.Thread(target=one)
    since = scratch.mark()
    thread.start()
    assert written.wait(60)
    scratch.written(spark.range(2), "two")
    scratch.release(spark, since, keep=0)
    released.set()
    thread.join(60)
    assert seen == [7]
    assert scratch.mark() == since
    left = [f for f in os.listdir(scratch.shared_dir(spark).removeprefix("file:")) if f.startswith(("tidemill-one-", "tidemill-two-"))]
    assert not left


class Session:
    """A session of which only the master and one setting are asked."""

    def __init__(self, master, path=None):
        self.sparkContext = self.conf = self
        self.master, self.path = master, path

    def get(self, key, default):
        return self.path if key == scratch.CONF else default

    def setCheckpointDir(self, path):
        self.chosen = path


def test_the_folder_is_the_sessions_own_or_a_temporary_one_of_a_local_master(monkeypatch):
    monkeypatch.setattr(scratch, "_own", [])
    assert scratch.shared_dir(Session("spark://host", "hdfs://store/x/")) == "hdfs://store/x"
    for master in ("spark://host", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="share"):
            scratch.shared_dir(Session(master))
    session = Session("local[2]")
    assert scratch.shared_dir(session) == session.chosen == scratch.shared_dir(session)
    os.rmdir(session.chosen)
