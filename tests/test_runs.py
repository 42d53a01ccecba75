"""Runs: budget, cache, convergence, publishing only on change, and what happens when input is broken."""

from __future__ import annotations

import json
import os
import threading
import time
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tidemill import scratch
from tidemill.functions import rules
from tidemill.operators import scanning
from tidemill.plans import run
from tidemill.plans.run import Config, run_file, run_once
from tidemill.sources import files, landing, publish, reading, state
from tidemill.streaming import runs

T0 = datetime(2026, 1, 1)


def postings(spark, n, text="We pay $20 per hour", change=None):
    rows = [(f"p{i:03d}", f"https://example.org/{i}", f"Job {i}", (change or {}).get(i, text), T0 + timedelta(minutes=i)) for i in range(n)]
    return spark.createDataFrame(rows, landing.POSTING)


def config(tmp_path, **more):
    return Config(str(tmp_path / "state"), str(tmp_path / "out"), **more)


def listing(spark, cfg):
    return json.loads(files.read_text(spark, f"{cfg.out}/{publish.LISTING}"))


def test_cold_start_converges_within_budget(spark, tmp_path):
    cfg, df = config(tmp_path, budget=4), postings(spark, 10)
    reports = [run_once(spark, df, cfg, T0 + timedelta(hours=k)) for k in range(4)]
    assert [(r.read, r.unread) for r in reports] == [(4, 6), (4, 2), (2, 0), (0, 0)]
    assert [r.published for r in reports] == [True, True, True, False]


def test_unread_postings_are_published_with_nulls(spark, tmp_path):
    cfg = config(tmp_path, budget=1)
    run_once(spark, postings(spark, 3), cfg, T0)
    found = {r["posting_id"]: r["sponsorship_barrier"] for r in listing(spark, cfg)}
    assert found == {"p000": None, "p001": None, "p002": False}


def test_changed_text_and_changed_rules_are_read_again(spark, tmp_path):
    cfg = config(tmp_path)
    run_once(spark, postings(spark, 3), cfg, T0)
    r = run_once(spark, postings(spark, 3, change={1: "We are unable to sponsor visas"}), cfg, T0 + timedelta(hours=1))
    assert r.read == 1
    assert {x["posting_id"]: x["sponsorship_barrier"] for x in listing(spark, cfg)}["p001"] is True
    r = run_once(spark, postings(spark, 3), config(tmp_path, used=rules.BARRIER + rules.AGENT[:1]), T0 + timedelta(hours=2))
    assert r.read == 3


def test_vanished_postings_leave_the_cache_and_duplicates_count_once(spark, tmp_path):
    cfg = config(tmp_path)
    df = postings(spark, 3)
    assert run_once(spark, df.unionByName(df), cfg, T0).read == 3
    run_once(spark, df.filter("posting_id <> 'p001'"), cfg, T0 + timedelta(hours=1))
    assert {r["posting_id"] for r in state.load(spark, cfg.state_root).collect()} == {"p000", "p002"}


def test_failed_reads_are_tried_after_the_rest_and_after_growing_pauses(spark, tmp_path):
    """Pauses of 15, 30, 60, 120 and 240 minutes; never given up, at most a day apart."""
    cfg = config(tmp_path, budget=2)
    df = postings(spark, 3, change={2: None})
    reads = [run_once(spark, df, cfg, T0 + timedelta(hours=k)).read for k in (0, 1, 2, 3, 4, 5, 200)]
    assert reads == [2, 2, 1, 1, 0, 1, 1]
    assert {r["posting_id"]: (r["status"], r["attempts"]) for r in state.load(spark, cfg.state_root).collect()} == {"p000": ("read", 1), "p001": ("read", 1), "p002": ("failed", 6)}


def test_lost_cache_means_a_cold_start(spark, tmp_path):
    cfg = config(tmp_path)
    run_once(spark, postings(spark, 2), cfg, T0)
    files.delete(spark, cfg.state_root)
    assert run_once(spark, postings(spark, 2), cfg, T0 + timedelta(hours=1)).read == 2


def test_versions_are_kept_and_pointed_to(spark, tmp_path):
    cfg = config(tmp_path, budget=1)
    for k in range(5):
        run_once(spark, postings(spark, 5), cfg, T0 + timedelta(hours=k))
    assert state.current(spark, cfg.state_root) == "v000000005"
    assert len([n for n in files.names(spark, cfg.state_root) if n.startswith("v")]) == state.KEEP


def test_truncated_snapshot_publishes_nothing(spark, tmp_path):
    cfg, path = config(tmp_path), tmp_path / "cut.json"
    path.write_text('[{"posting_id":"a","text":"x"},{"posting_id":"b"},{"posting_id":')
    with pytest.raises(landing.CorruptSnapshot):
        run_file(spark, str(path), cfg, T0)
    assert not files.exists(spark, f"{cfg.out}/{publish.LISTING}")


def test_snapshot_keeps_unknown_fields(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps([{"posting_id": "a", "text": "x", "salary": 5}, {"posting_id": "b"}]))
    df = landing.read_snapshot(spark, str(path), rest="rest")
    assert {r[0]: r[1] for r in df.select("posting_id", F.expr("try_variant_get(rest, '$.salary', 'int')")).collect()} == {"a": 5, "b": None}
    assert run_file(spark, str(path), config(tmp_path), T0).read == 2


def test_fetch_is_conditional_and_bounded(spark, tmp_path):
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            same = self.headers.get("If-None-Match") == "v1"
            self.send_response(304 if same else 200)
            self.send_header("ETag", "v1")
            self.end_headers()
            if not same:
                self.wfile.write(b'[{"posting_id":"a"}]')

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/x.json"
    path, mark = landing.fetch(spark, url, str(tmp_path), ("127.0.0.1",))
    assert landing.read_snapshot(spark, path).count() == 1
    assert landing.fetch(spark, url, str(tmp_path), ("127.0.0.1",), mark) == (None, "v1")
    with pytest.raises(ValueError, match="host"):
        landing.fetch(spark, url, str(tmp_path), ("example.org",))
    server.shutdown()


def test_consumer_reads_only_what_changed(spark, tmp_path):
    cfg = config(tmp_path)
    run_once(spark, postings(spark, 1), cfg, T0)
    body, mark = publish.read_if_changed(spark, cfg.out, None)
    assert json.loads(body)[0]["posting_id"] == "p000"
    assert publish.read_if_changed(spark, cfg.out, mark) == (None, mark)


LISTING_SCHEMA = "posting_id string, url string, title string, sponsorship_barrier boolean, agent_directed boolean"


def test_a_run_publishes_any_number_of_rows(spark, tmp_path):
    cfg = config(tmp_path, most_rows=3)
    run_once(spark, postings(spark, 2), cfg, T0)
    assert len(listing(spark, cfg)) == 2
    assert run_once(spark, postings(spark, 7, change={4: None}), cfg, T0 + timedelta(hours=1)).published
    found = {r["posting_id"]: r["sponsorship_barrier"] for r in publish.read_listing(spark, cfg.out, LISTING_SCHEMA).collect()}
    assert found == {f"p{i:03d}": None if i == 4 else False for i in range(7)}
    # The fixed names hold the manifest of the parts, and a plain consumer gets it; nothing changed is nothing published.
    body, mark = publish.read_if_changed(spark, cfg.out, None)
    assert body == files.read_text(spark, f"{cfg.out}/{publish.LISTING}")
    parts = json.loads(body)
    rows = [json.loads(x) for p in parts["parts"] for x in files.read_text(spark, f"{cfg.out}/{p}").splitlines()]
    assert parts["rows"] == len(rows) == 7
    assert {r["posting_id"] for r in rows} == set(found)
    assert publish.read_if_changed(spark, cfg.out, mark) == (None, mark)
    again = [run_once(spark, postings(spark, 7, change={4: None}), cfg, T0 + timedelta(hours=h)) for h in (2, 3, 3.5)]
    assert [r.published for r in again] == [True, True, False]  # failed attempts are counted in the cache
    assert run_once(spark, postings(spark, 1), cfg, T0 + timedelta(hours=9)).published
    assert len(listing(spark, cfg)) == 1
    assert publish.read_listing(spark, cfg.out, LISTING_SCHEMA).count() == 1


def test_files_are_sorted_arrays_of_all_rows(spark, tmp_path):
    df = postings(spark, 500, change={i: None for i in range(0, 500, 7)}).select("posting_id", "text").repartition(7)
    for n in (0, 1, 500):
        publish.write_array(df.filter(F.col("posting_id") < f"p{n:03d}"), ["posting_id"], str(tmp_path / "a.json"), n)
        rows = json.loads(files.read_text(spark, str(tmp_path / "a.json")))
        assert [r["posting_id"] for r in rows] == [f"p{i:03d}" for i in range(n)]
        assert all(set(r) == {"posting_id", "text"} for r in rows)
    assert files.names(spark, str(tmp_path)) == [".a.json.crc", "a.json"] or files.names(spark, str(tmp_path)) == ["a.json"]


def test_runs_leave_neither_scratch_tables_nor_old_releases(spark, tmp_path):
    cfg, made = config(tmp_path, budget=1), scratch.mark()
    before = set(os.listdir(scratch.shared_dir(spark).removeprefix("file:")))
    for k in range(7):
        run_once(spark, postings(spark, 6), cfg, T0 + timedelta(hours=k))
    assert scratch.mark() == made
    assert set(os.listdir(scratch.shared_dir(spark).removeprefix("file:"))) <= before
    assert len(files.names(spark, f"{cfg.out}/releases")) == publish.KEEP


@pytest.mark.parametrize("most", [1000, 1])
def test_deleting_the_published_cache_means_a_cold_start(spark, tmp_path, most):
    cfg = config(tmp_path, budget=2, most_rows=most)
    for k in range(2):
        run_once(spark, postings(spark, 4), cfg, T0 + timedelta(hours=k))
    assert run_once(spark, postings(spark, 4), cfg, T0 + timedelta(hours=3)).read == 0
    files.delete(spark, f"{cfg.out}/{publish.CACHE}")
    reports = [run_once(spark, postings(spark, 4), cfg, T0 + timedelta(hours=4 + k)) for k in range(3)]
    assert [(r.read, r.unread) for r in reports] == [(2, 2), (2, 0), (0, 0)]
    assert [r.published for r in reports] == [True, True, False]


def test_a_consumer_gets_the_listing_of_its_mark(spark, tmp_path):
    cfg = config(tmp_path)
    run_once(spark, postings(spark, 1), cfg, T0)
    # The next listing is there already, its mark is not.
    files.write_text(spark, f"{cfg.out}/{publish.LISTING}", "[]")
    body, _ = publish.read_if_changed(spark, cfg.out, None)
    assert json.loads(body)[0]["posting_id"] == "p000"
    assert publish.read_if_changed(spark, str(tmp_path / "nothing"), None) == (None, None)


@pytest.fixture
def server():
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] = asked.get(self.path, 0) + 1
            if self.path == "/slow-start" and asked[self.path] < 3:
                self.send_response(503)
            elif self.path == "/away":
                self.send_response(302)
                self.send_header("Location", "http://example.org/")
            elif self.path == "/none":
                self.send_response(404)
            else:
                self.send_response(200)
            self.end_headers()
            if self.path == "/large":
                self.wfile.write(b"x" * (reading.MOST_BYTES + 1))
            elif self.path == "/long":
                self.wfile.write(b"<p>" + b"x " * (5 << 19) + b"We will not sponsor visas</p>")
            else:
                self.wfile.write(b"<p>We will not sponsor visas</p>")

        def log_message(self, *args):
            pass

    asked: dict[str, int] = {}
    own = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=own.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{own.server_port}", asked
    own.shutdown()


def test_addresses_are_read_within_bounds(server):
    base, asked = server
    hosts = ("127.0.0.1",)
    get = lambda path, h=hosts: reading.read(base + path, h, backoff=0.01)
    assert "sponsor" in get("/ok")
    assert "sponsor" in get("/slow-start")
    assert asked["/slow-start"] == 3
    assert get("/long").endswith("sponsor visas</p>")
    assert get("/none") is get("/large") is get("/away") is None
    why = lambda path, h=hosts: reading.body_of(base + path, h, backoff=0.01)[1]
    assert [why(p) for p in ("/ok", "/none", "/large")] == [None, "status 404", reading.TOO_LARGE]
    assert why("/ok", ("example.org",)) == "not allowed"
    assert asked["/none"] == 2
    assert get("/unasked", ("example.org",)) is None
    assert "/unasked" not in asked
    assert reading.read("file:///etc/hosts", hosts) is reading.read(None, hosts) is None


def test_a_run_reads_postings_at_their_addresses(spark, tmp_path, server):
    base, asked = server
    rows = [("a", f"{base}/ok", "t", None, T0), ("b", f"{base}/none", "t", None, T0), ("c", f"{base}/own", "t", "Its own text", T0), ("d", None, "t", None, T0)]
    cfg = config(tmp_path, hosts=("127.0.0.1",))
    assert run_once(spark, spark.createDataFrame(rows, landing.POSTING), cfg, T0).read == 4
    assert {r["posting_id"]: r["sponsorship_barrier"] for r in listing(spark, cfg)} == {"a": True, "b": None, "c": False, "d": None}
    assert "/own" not in asked


def test_every_record_is_kept_once_with_its_rest(spark, tmp_path):
    records = [{"posting_id": "a", "text": "x", "salary": 1}, {"posting_id": "a", "text": "y", "salary": 2}, {"posting_id": None, "salary": 3, "updated_at": "2026-01-01T00:00:00Z"}, {"salary": 4, "title": 5}]
    (tmp_path / "array.json").write_text(json.dumps(records))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records)))
    (tmp_path / "one.json").write_text(json.dumps(records[0]))
    for name, lines in (("array", False), ("lines", True)):
        df = landing.read_snapshot(spark, str(tmp_path / f"{name}.json"), lines=lines, rest="rest")
        assert df.columns == [*landing.POSTING.names, "rest"]
        rows = df.withColumn("salary", F.expr("try_variant_get(rest, '$.salary', 'int')")).drop("rest").orderBy("salary").collect()
        assert [(r["posting_id"], r["text"], r["salary"]) for r in rows] == [("a", "x", 1), ("a", "y", 2), (None, None, 3), (None, None, 4)]
        assert [r["title"] for r in rows] == [None, None, None, "5"]
        assert rows[2]["updated_at"] == T0
        plain = landing.read_snapshot(spark, str(tmp_path / f"{name}.json"), lines=lines)
        assert sorted(map(str, plain.collect())) == sorted(map(str, df.drop("rest").collect()))
    assert landing.read_snapshot(spark, str(tmp_path / "one.json"), rest="rest").count() == 1


def test_stream_equals_runs(spark, tmp_path):
    (tmp_path / "land").mkdir()
    for k in range(2):
        (tmp_path / "land" / f"{k}.json").write_text(json.dumps([{"posting_id": f"p{i}", "text": "Unable to sponsor", "updated_at": "2026-01-01T00:00:00Z"} for i in range(k + 1)]))
    cfg = config(tmp_path)
    q = runs.start(spark, str(tmp_path / "land"), str(tmp_path / "cp"), cfg)
    q.awaitTermination(120)
    assert {r["posting_id"] for r in listing(spark, cfg)} >= {"p0"}
    q = runs.start(spark, str(tmp_path / "land"), str(tmp_path / "cp"), cfg)
    q.awaitTermination(120)
    assert q.lastProgress is None or q.lastProgress["numInputRows"] == 0


def test_streamed_arrivals_equal_the_table(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts")
    expected = {(r["start"], r["n"]) for r in runs.arrivals(events).collect()}
    events.repartition(3).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("ts timestamp_ntz").parquet(str(tmp_path / "e"))
    q = runs.arrivals(stream).writeStream.outputMode("complete").format("memory").queryName("arrived").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r["start"], r["n"]) for r in spark.table("arrived").collect()} == expected


def test_ranks_are_gapless(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    found = [r["n"] for r in scanning.ranked(df, ["k", "id"], "n").orderBy("k", "id").collect()]
    assert found == list(range(1, 1001))


def _shuffled(spark):
    """Bytes that all tasks so far have written for shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    time.sleep(0.3)
    every = sc.statusStore().executorList(False)
    return sum(every.apply(k).totalShuffleWrite() for k in range(every.length()))


@pytest.mark.parametrize("budget", [1 << 30, 700])
def test_texts_are_dealt_out_once_a_run(spark, tmp_path, budget):
    """Whether all or many are read, the shuffles of a run take little more than the texts once: neither the state nor the order moves them again."""
    rest = F.concat(*(F.sha2(F.concat("id", F.lit(f":{k}")), 512) for k in range(100)))
    df = spark.range(800).select(F.concat(F.lit("p"), "id").alias("posting_id"), F.lit("u").alias("url"), F.lit("t").alias("title"), rest.alias("text"), F.lit(T0).cast("timestamp").alias("updated_at"))
    df.write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    since = _shuffled(spark)
    run.identified(df).write.parquet(str(tmp_path / "once"))
    once, since = _shuffled(spark) - since, _shuffled(spark)
    cfg = config(tmp_path, budget=budget)
    assert run_once(spark, df, cfg, T0).read == min(budget, 800)
    assert 1_000_000 < once and _shuffled(spark) - since < 1.5 * once


@pytest.mark.parametrize("budget", [0, 1, 7, 20, 33, 59, 60, 61])
def test_the_next_postings_are_the_first_in_order(spark, budget):
    """Failed ones last, the latest first, those without a time after all others, then by id: also where times and attempts are equal."""
    rows = [(f"p{i:03d}", [None, 1, 3][i % 3], None if i % 4 == 0 else T0 + timedelta(minutes=i % 5), f"text {i}") for i in range(60)]
    todo = spark.createDataFrame(rows, "posting_id string, attempts int, updated_at timestamp, text string").repartition(5)
    wanted = sorted(rows, key=lambda r: (r[1] or 0, r[2] is None, -(r[2].timestamp() if r[2] else 0), r[0]))[:budget]
    got = run.first(todo, 60, budget)
    assert got.columns == todo.columns and sorted(r["posting_id"] for r in got.collect()) == sorted(r[0] for r in wanted)


def test_the_state_is_known_by_id_content_and_rules(spark, tmp_path):
    cfg = config(tmp_path)
    known = [("a", "h", rules.version(), T0, "read", 1), ("b", "old", rules.version(), T0, "failed", 4), ("c", "h", "other", T0, "read", 2), ("gone", "h", rules.version(), T0, "read", 1)]
    state_rows = spark.createDataFrame([(*k, None, None, None, None) for k in known], state.STATE)
    posts = spark.createDataFrame([(x, "h") for x in "abcd"], "posting_id string, content_hash string")
    got = {r["posting_id"]: (r["status"], r["attempts"]) for r in run.tagged(posts, state_rows, cfg).collect()}
    assert got == {"a": ("read", 1), "b": (None, None), "c": (None, None), "d": (None, None)}
