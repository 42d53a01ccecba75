from __future__ import annotations

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA, as_rows
from tidemill.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes: dict):
    """Targets by resharing the excess again and again; sources in order, null last."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / w for s in order}
        over = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def solved(xs, target):
    """The multiplier by bisection."""
    lo, hi = -50.0, 50.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(x * min(3, math.exp(min(mid * x, 2))) for x in xs) < target else (lo, mid)
    return lo


def check(rows, source_of, sizes_of):
    sizes, taken, by = defaultdict(int), defaultdict(int), defaultdict(list)
    for r in rows:
        s = source_of(r)
        assert r["size"] == sizes_of(r)
        assert 0 <= r["copies"] <= 3
        sizes[s] += r["size"]
        taken[s] += r["copies"] * r["size"]
        by[s].append(r)
    expected = shares(dict(sizes))
    for s, own in by.items():
        assert {r["source_size"] for r in own} == {sizes[s]}
        assert own[0]["target"] == pytest.approx(expected[s], rel=1e-9, abs=1e-9)
    return sizes, taken, expected, by


def test_documents(spark):
    docs = {r["doc_id"]: r for r in queries.table(spark, f"{DATA}/sf0.01", "documents").collect()}
    rows = mixing.mix(queries.table(spark, f"{DATA}/sf0.01", "documents")).collect()
    assert len(rows) == len(docs)
    sizes, taken, expected, by = check(rows, lambda r: docs[r["doc_id"]]["source"], lambda r: len(WORD.findall(docs[r["doc_id"]]["text"])))
    for s in sizes:
        assert taken[s] == pytest.approx(expected[s], rel=0.01)
        lam = solved([r["size"] for r in by[s]], expected[s])
        for r in by[s]:
            assert r["rate"] == pytest.approx(min(3, math.exp(lam * r["size"])), rel=1e-3)


def test_query_takes_what_the_contract_says(spark):
    """All columns of the registered query, recomputed from the texts."""
    d = f"{DATA}/sf0.001"
    docs = {r["doc_id"]: r for r in queries.table(spark, d, "documents").collect()}
    rows = {r["doc_id"]: r for r in queries.op10_mix(spark, d).collect()}
    assert set(rows) == set(docs)
    sizes, by = defaultdict(int), defaultdict(list)
    for k, r in rows.items():
        assert r["size"] == len(WORD.findall(docs[k]["text"]))
        sizes[docs[k]["source"]] += r["size"]
        by[docs[k]["source"]].append(r)
    expected = shares(dict(sizes))
    for s, own in by.items():
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(expected[s], rel=1e-9) for r in own)
        assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in own)
        lam = solved([r["size"] for r in own], expected[s])
        # Along falling sizes every document takes up what the larger ones left over.
        over, left = 0.0, []
        for r in sorted(own, key=lambda r: (r["size"], r["doc_id"]), reverse=True):
            want = over + min(3, math.exp(min(2, lam * r["size"]))) * r["size"]
            n = max(0, min(3, math.floor(want / r["size"] + 0.5))) if r["size"] else 0
            over = want - n * r["size"]
            left.append(abs(n * r["size"] - r["taken"]))
        blocks = math.ceil(len(own) / mixing.BLOCK_ROWS)
        assert abs(sum(r["taken"] for r in own) - expected[s]) <= blocks * max(r["size"] for r in own) / 2 + abs(over) + 1
        if blocks == 1:
            assert sum(left) == 0


def test_query_equals_sql(spark, duck):
    assert as_rows(queries.op10_mix(spark, f"{DATA}/sf0.01").toArrow()) == as_rows(duck(queries.OP10_SQL, "sf0.01"))


def test_query_equals_sql_on_odd_rows(spark, tmp_path):
    import duckdb

    rows = [(i % 150, f"s{i % 5}" if i % 7 else None, None if i % 11 == 0 else "w " * (1 + i * i % 40)) for i in range(600)] + [(None, "s1", "x y")] * 40 + [(7, "s2", "same words")] * 900 + [(9, "void", "")]
    spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert as_rows(queries.op10_mix(spark, str(tmp_path)).toArrow()) == as_rows(c.sql(queries.OP10_SQL).to_arrow_table())


def test_rows_that_one_id_or_text_shares_fill_no_block(spark, monkeypatch):
    monkeypatch.setattr(mixing, "APART", 1000)
    one = spark.range(100_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.expr("case when id % 2 = 0 then 'same text here' else concat('text number ', id, repeat(' w', id % 50)) end").alias("text"))
    more = spark.range(2000).select((F.col("id") + 10).alias("doc_id"), F.lit("b").alias("source"), F.lit("x y z").alias("text"))
    out = mixing.mix(one.unionByName(more))
    per = out.groupBy("doc_id", "size").agg(F.count("*").alias("n"), F.min("copies").alias("a"), F.max("copies").alias("b"))
    assert out.count() == 102_000
    assert per.filter("doc_id = 5 and b - a > 1").count() == 0
    r = out.filter("doc_id = 5").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target")).first()
    assert r["taken"] == pytest.approx(r["target"], rel=0.001)


def test_sources_that_do_not_settle_are_no_result(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ITERATIONS", 1)
    df = spark.createDataFrame([(i, f"s{i % 3}", "w " * (1 + i % 17)) for i in range(60)], "doc_id long, source string, text string")
    with pytest.raises(RuntimeError, match="settled"):
        mixing.mix(df)


def test_carried_columns_of_any_name(odd):
    out = mixing.mix(odd, carry=("size", "rate", "n", "copies", "target", "_own"))
    assert out.columns == ["doc_id", "n", "_own", "size", "source_size", "target", "rate", "copies"]
    assert {(r["n"], r["_own"]) for r in out.collect()} == {("-", "-")}
    assert out.schema["size"].dataType.typeName() == "long"


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, "big", "w " * 50) for i in range(200)] + [(1000, "small", "a b c"), (1001, "tiny", "x"), (1002, None, "n n"), (1003, "void", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix(df).collect()
    source = {r[0]: r[1] for r in rows}
    sizes, taken, expected, _ = check(out, lambda r: source[r["doc_id"]], lambda r: len(rows[r["doc_id"]][2].split()) if r["doc_id"] < 200 else len(next(x[2] for x in rows if x[0] == r["doc_id"]).split()))
    assert taken["small"] == 9
    assert taken["tiny"] == 3
    assert taken[None] == 6
    assert taken["big"] == pytest.approx(expected["big"], abs=50)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = queries.table(spark, f"{DATA}/sf0.001", "documents")
    runs = [{r["doc_id"]: (r["copies"], r["rate"], r["target"]) for r in mixing.mix(docs.repartition(n)).collect()} for n in (1, 7)]
    assert runs[0] == runs[1]


def test_odd_rows(odd):
    out = mixing.mix(odd).collect()
    assert len(out) == odd.count()
    assert sorted(r["size"] for r in out if r["doc_id"] in (7, 8, 9)) == [0, 0, 0]
    again = mixing.repeated(odd, mixing.mix(odd).select("doc_id", "copies"))
    assert again.columns == odd.columns
    assert again.filter("doc_id is null").count() == sum(r["copies"] for r in out if r["doc_id"] is None)


def test_empty_table(none):
    assert mixing.mix(none).count() == 0


def test_no_python_on_the_executors(spark, capsys):
    queries.op10_mix(spark, f"{DATA}/sf0.001").explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
