from __future__ import annotations

import random

import numpy as np
import pytest

from tests.conftest import DATA, as_rows
from tidemill.llm import near_dedup, queries


def brute(rows, width, percent=80):
    """{id: component} over all pairs of rows."""
    def shingles(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or "")).translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ")
        w = [x for x in w if x]
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({("short", *w)} if w else set())

    low = lambda d: -(1 << 63) if d is None else d
    sets = [(low(d), shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    back = lambda d: None if d == -(1 << 63) else d
    return {back(d): back(top(d)) for d, _ in sets}, {back(d): len(s) for d, s in sets}


def ours(df, width):
    out = near_dedup.near_duplicates(df, width=width).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    assert len({(r["doc_id"], r["component_id"]) for r in out}) == len({r["doc_id"] for r in out})
    return {r["doc_id"]: r["component_id"] for r in out}, {r["doc_id"]: r["n_shingles"] for r in out}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize(("width", "chunk", "pivots", "meet"), [(2, 1024, 16, 2048), (5, 8, 16, 2048), (5, 4, 2, 8), (2, 3, 0, 5)])
def test_chains_and_groups(spark, monkeypatch, width, chunk, pivots, meet):
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    monkeypatch.setattr(near_dedup, "PIVOTS", pivots)
    monkeypatch.setattr(near_dedup, "MEET", meet)
    rng, rows = random.Random(11), []
    for g in range(6):
        words = [f"g{g}w{rng.randrange(300)}" for _ in range(120)]
        for _ in range(12):
            rows.append((len(rows), " ".join(words)))
            words = edited(rng, words, rng.choice((0, 1, 2, 5)))
    rows += [(len(rows) + i, " ".join(f"x{rng.randrange(40)}" for _ in range(60))) for i in range(40)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ours(df, width) == brute(rows, width)


def template(n, words=301):
    """Documents that differ from one another in one word each."""
    return [(i, " ".join([f"w{k}" for k in range(words - 1)] + [f"own{i}"])) for i in range(n)]


def test_copies_of_members_grow_with_the_group_and_no_faster(spark):
    per = []
    for n in (2_000, 8_000, 32_000):
        docs = spark.createDataFrame(template(n), "id long, t string").repartition(4)
        reps = near_dedup._signatures(docs, 5).select("id", "a", "bands", "sketch")
        members = near_dedup._members(reps)
        homes = members.filter("home").count()
        assert homes <= near_dedup.BANDS * n
        per.append(members.count() / n)
    assert per[2] <= 1.05 * per[0]
    assert max(per) <= near_dedup.BANDS * (1 + 2 * near_dedup.PIVOTS / near_dedup.CHUNK)


@pytest.mark.parametrize("key", [None, 7])
def test_copies_of_members_grow_with_the_texts_of_one_id_and_no_faster(spark, key):
    per = []
    for n in (500, 2_000):
        docs = spark.createDataFrame([(key or near_dedup._NONE, t) for _, t in template(n)], "id long, t string").repartition(4)
        members = near_dedup._members(near_dedup._signatures(docs, 5).select("id", "a", "bands", "sketch"))
        per.append(members.count() / n)
    assert per[1] <= 1.2 * per[0]


def test_many_texts_of_one_id(spark):
    """A third of the rows without an id, a third of one id, and repeated rows; near copies link across them."""
    texts, rng = [t for _, t in template(60, 61)], random.Random(3)
    apart = [" ".join(f"a{i}b{k}" for k in range(30)) for i in range(300)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 1000 + i, t) for i, t in enumerate(apart)]
    rows += [(2000 + i, t + " end") for i, t in enumerate(apart[:40])] + [(3000 + i, t) for i, t in enumerate(texts)]
    rows += [(7, apart[1])] * 200 + [(7, texts[0])] * 50
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ours(df, 5)[0] == brute(rows, 5)[0]


def test_sets_are_there_once(spark):
    rows = [(7, "one two three four five six")] * 40 + [(7, "other words than these are five")] * 3 + [(9, "one two three four five six")]
    docs = spark.createDataFrame(rows, "id long, t string").repartition(4)
    assert near_dedup._sets(docs, docs.select("id").distinct(), 5).count() == 3


def test_a_large_group_is_one_component_without_meetings(spark, monkeypatch):
    met = []
    real = near_dedup._meetings
    monkeypatch.setattr(near_dedup, "_meetings", lambda *a: met.append(real(*a)) or met[-1])
    rows = template(3_000) + [(10_000 + i, " ".join(f"x{i}y{k}" for k in range(50))) for i in range(50)]
    components, _ = ours(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5)
    assert components == {i: 0 if i < 3_000 else i for i, _ in rows}
    assert met[0].count() == 0


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    components, sizes = ours(odd, 2)
    expected, n = brute(rows, 2)
    assert sizes == n
    assert components == expected


def test_repeated_ids_join_what_their_texts_reach(spark):
    a, b, c = ("w%d x y z q" % i for i in range(3))
    rows = [(5, a), (5, b), (3, b), (9, a), (4, c), (None, c), (None, "other words than those")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ours(df, 2)[0] == brute(rows, 2)[0] == {5: 3, 3: 3, 9: 3, 4: None, None: None}


def test_empty_table(none):
    assert near_dedup.near_duplicates(none).count() == 0


def test_query_equals_sql(spark, duck):
    assert as_rows(queries.op9_near(spark, f"{DATA}/sf0.001").toArrow()) == as_rows(duck(queries.OP9_SQL, "sf0.001"))


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for shared in (600, 750, 900):
        for _ in range(10):
            x = rng.integers(0, 2**63, 1000).astype(np.uint64)
            y = np.r_[x[:shared], rng.integers(0, 2**63, 1000 - shared).astype(np.uint64)]
            s = near_dedup.samples(np.concatenate([x, y]), np.array([1000, 1000]))
            u = np.bitwise_count(np.bitwise_xor(*near_dedup.odd_sketches(s))).sum()
            estimate = 1 + near_dedup.SKETCH / (4 * near_dedup.HASHES) * np.log(1 - 2 * u / near_dedup.SKETCH)
            errors.append(estimate - shared / (2000 - shared))
    assert np.std(errors) < 0.05
    assert abs(np.mean(errors)) < 0.02


def test_bands_find_pairs_at_the_threshold():
    rng, missed = np.random.default_rng(4), 0
    for _ in range(200):
        x = rng.integers(0, 2**63, 900).astype(np.uint64)
        y = np.r_[x[:800], rng.integers(0, 2**63, 100).astype(np.uint64)]
        a, b = near_dedup.band_hashes(near_dedup.samples(np.concatenate([x, y]), np.array([900, 900])))
        missed += not (a == b).any()
    assert missed == 0


def test_components_of_a_long_path(spark):
    from tidemill.llm.components import components

    order = list(range(200))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(900, 901), (7, 7)], "a long, b long")
    found = {r["v"]: r["component"] for r in components(links, "a", "b").collect()}
    assert found == {**dict.fromkeys(range(200), 0), 900: 900, 901: 900}
