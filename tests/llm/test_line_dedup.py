from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import DATA, as_rows
from tidemill.llm import bloom, line_dedup, queries

SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """(doc, n_lines, n_dropped, text) by dictionaries."""
    def key(line):
        k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))
        return k if len(k) >= 10 else None

    docs = defaultdict(set)
    low = lambda d: -(1 << 63) if d is None else d
    for d, t in rows:
        for line in (t or "").split("\n"):
            if k := key(line):
                docs[k].add(low(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (k := key(x)) or len(docs[k]) < 2 or min(docs[k]) == low(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def ours(df, **more):
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in line_dedup.dedup_lines(df, **more).collect())


@pytest.mark.parametrize("keys", [1 << 20, 0])
def test_random_lines_both_ways(spark, keys):
    rng = random.Random(7)
    pool = [rng.choice(["  ", "\t", ""]) + rng.choice(["Äpfel und Birnen", "SHORT", "a line of words", "ééééééééé", "éééééééééé"]) + str(rng.randint(0, 40)) * rng.randint(0, 2) for _ in range(60)]
    rows = [(i % 90, "\n".join(rng.choices(pool, k=rng.randint(0, 6)))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert ours(df, broadcast_keys=keys) == brute(rows)


@pytest.mark.parametrize("keys", [1 << 20, 0])
def test_odd_rows(odd, keys):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert ours(odd, broadcast_keys=keys) == brute(rows)


def test_empty_table(none):
    assert line_dedup.dedup_lines(none).count() == 0


def test_query_equals_sql(spark, duck):
    assert as_rows(queries.op4_lines(spark, f"{DATA}/sf0.001").toArrow()) == as_rows(duck(queries.OP4_SQL, "sf0.001"))


def test_a_full_filter_costs_no_result(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 128)
    monkeypatch.setattr(line_dedup, "FLUSH_KEYS", 5)
    rows = [(i, f"line number {i % 50} of these\nand number {i} alone") for i in range(300)]
    assert ours(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_bloom_has_what_was_added():
    layout = bloom.layout(1 << 18)
    h = np.random.default_rng(0).integers(0, 1 << 63, 4000).astype(np.uint64)
    h.sort()
    segment, places = bloom.place(h, *layout)
    bits = bloom.empty(sum(layout))
    flat = places + (segment << layout[1])
    bloom.add(bits, np.unique(flat))
    assert bloom.test(bits, flat).all()
    other = bloom.place(h ^ np.uint64(0xFFFF), *layout)
    assert bloom.test(bits, other[1] + (other[0] << layout[1])).all(axis=0).mean() < 0.05
    assert (bloom.unpacked(bloom.packed(np.unique(flat))) == np.unique(flat)).all()


def test_null_text_counts_as_one_empty_line_in_the_query(spark, tmp_path, duck):
    import duckdb

    rows = [(1, None), (2, ""), (3, "a line of some length\nshort"), (4, "A line of some LENGTH \nshort"), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op4_lines(spark, str(tmp_path)).toArrow()
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert as_rows(found) == as_rows(c.sql(queries.OP4_SQL).to_arrow_table())


def test_what_is_broadcast_is_bounded(spark, monkeypatch):
    """A filter that holds more than may be broadcast is folded to the bound, and the result is the same."""
    rows = [(i, "\n".join(f"a repeated line number {i % 40} {k}" for k in range(60)) + f"\nan own line of {i} here") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = brute(rows)
    for bound in (1 << 10, 1 << 14):
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", bound)
        second, layout = line_dedup._second(docs, line_dedup.MIN_CODE_POINTS, "text")
        assert second.nbytes <= bound
        out = line_dedup.dedup_lines(docs, broadcast_keys=(0 if bound == 1 << 10 else 1 << 20)).collect()
        assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out) == expected
