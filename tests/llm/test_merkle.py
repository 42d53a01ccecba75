from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA, as_rows
from tidemill.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Each leaf's siblings, level by level, and the root, by lists."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for p, i in zip(paths, at, strict=True):
            run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
            p.append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
        nodes, at = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)], [i // 8 for i in at]
    return paths, nodes[0]


def plain_fold(leaf, path):
    for before, after in path:
        leaf = h(before, leaf, after)
    return leaf


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 72, 73, 511, 512, 513, 577, 1000])
def test_traversal_gives_every_path(n):
    leaves = [h(str(i)) for i in range(n)]
    paths, root = plain_tree(leaves)
    levels = merkle.levels_of(n, 9)
    assert list(merkle.traversal(leaves, levels)) == paths
    tree = merkle.Treehash(levels)
    for x in leaves:
        tree.add(x)
    assert tree.close() == [root]


def test_traversal_holds_a_few_runs_a_level():
    held = {}
    for levels in (2, 3, 4):
        seen = []
        for _ in merkle.traversal([h(str(i)) for i in range(8**levels)], levels, seen.append):
            pass
        held[levels] = max(seen)
    assert all(n <= 24 * levels for levels, n in held.items())
    assert held[4] - held[3] <= 24


def test_traversal_spreads_its_work(monkeypatch):
    """A run is there when it is needed: no leaf has to make up for steps that were left out."""
    steps = []

    class Counting(merkle.Treehash):
        def add(self, node):
            steps[-1] += 1
            super().add(node)

    monkeypatch.setattr(merkle, "Treehash", Counting)
    steps.append(0)
    for _ in merkle.traversal([str(i) for i in range(8**4)], 4):
        steps.append(0)
    assert max(steps[1:]) <= 4


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, duck, sf):
    assert as_rows(queries.op12_manifest(spark, f"{DATA}/{sf}").toArrow()) == as_rows(duck(queries.OP12_SQL, sf))


def test_query_by_hand(spark):
    docs = queries.table(spark, f"{DATA}/sf0.001", "documents").collect()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: h(*map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))
    langs = defaultdict(list)
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        langs[r["lang"]].append(r)
    trees = {k: plain_tree([leaf(r, r["text"]) for r in rows]) for k, rows in langs.items()}
    order = sorted(trees, key=lambda k: k.encode())
    tops, root = plain_tree([trees[k][1] for k in order])
    expected = {}
    for k, top in zip(order, tops, strict=True):
        for r, path in zip(langs[k], trees[k][0], strict=True):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            shown = leaf(r, low) if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 else leaf(r, r["text"])
            folded = plain_fold(shown, path + top)
            expected[r["doc_id"]] = (r["doc_id"], leaf(r, r["text"]), trees[k][1], root, h(*(x for step in path + top for x in step)), folded, folded == root)
    found = {r["doc_id"]: tuple(r) for r in queries.op12_manifest(spark, f"{DATA}/sf0.001").collect()}
    assert found == expected
    assert Counter(r[-1] for r in found.values())[False] > 20


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_blocks_of_any_height_prove_alike(spark, levels):
    """A hot group, many small ones, a null one, equal keys and equal rows."""
    rng = random.Random(levels)
    rows = [(i if i % 50 else None, "hot" if i % 3 else rng.choice([None, "", "a", "é", "ab", *map(str, range(60))]), f"x{i // 4 if i > 1500 else i}") for i in range(1700)]
    df = spark.createDataFrame(rows, "id int, g string, path string").withColumn("leaf", F.sha2(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), "path"), 256))
    got = merkle.prove(df, "leaf", "id", "g", levels).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["g"]].append((r["id"] is not None, r["id"] or 0, r["leaf"]))
    trees = {g: plain_tree([x[-1] for x in sorted(v)]) for g, v in groups.items()}
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    tops, root = plain_tree([trees[g][1] for g in order])
    expected = Counter((g, x[-1], trees[g][1], root, tuple(p + t)) for g, t in zip(order, tops, strict=True) for x, p in zip(sorted(groups[g]), trees[g][0], strict=True))
    assert Counter((r["g"], r["leaf"], r["subroot"], r["root"], tuple(tuple(s) for s in r["path"])) for r in got) == expected
    assert {r["folded"] for r in got} == {root}


def test_odd_rows_clashes_and_empty_tables(odd, none):
    rows = odd.withColumns({"_pos": F.lit("-"), "_node": F.lit(1), "path": F.lit("p"), "a b": F.lit(2)}).withColumn("leaf", merkle.leaf_of(F.col("doc_id"), F.col("source"), F.col("text")))
    out = merkle.prove(rows, "leaf", "doc_id", "source")
    assert out.columns == [c for c in rows.columns if c != "path"] + ["subroot", "root", "path"]
    got = out.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert len(got) == odd.count()
    assert {r["folded"] for r in got} == {got[0]["root"]}
    assert {(r["_pos"], r["_node"], r["a b"]) for r in got} == {("-", 1, 2)}
    assert merkle.prove(none.withColumn("leaf", F.lit("x")), "leaf", "doc_id", "source").count() == 0
    lone = odd.filter("doc_id = 13").withColumn("leaf", F.lit("ab"))
    assert [tuple(r) for r in merkle.prove(lone, "leaf", "doc_id", "source").select("subroot", "root", F.size("path")).collect()] == [("ab", "ab", 0)]


def test_nulls_differ_from_texts_that_look_like_them(spark):
    df = spark.createDataFrame([(None, "a"), ("-", "a"), ("", "a"), ("1:a", None)], "x string, y string")
    assert df.select(merkle.leaf_of(F.col("x"), F.col("y"))).distinct().count() == 4
    assert df.select(merkle.leaf_of(F.col("x"))).first()[0] == h("-")
