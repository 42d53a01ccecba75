from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemill.llm import bytetext, quality, queries, toxicity

SF = "sf0.1"


def held_out(spark, name, label):
    """Scores and labels of the held-out rows."""
    rows = queries.QUERIES[name](spark, f"{DATA}/{SF}").filter("held_out").join(queries.table(spark, f"{DATA}/{SF}", "labels"), "doc_id").collect()
    return np.array([r["score"] for r in rows]), np.array([r[label] for r in rows]), np.array([r["predicted"] for r in rows])


def auc(s, y):
    order = np.argsort(np.argsort(s))
    n, m = (y == 1).sum(), (y == 0).sum()
    return (order[y == 1].sum() - n * (n - 1) / 2) / (n * m)


def test_quality_on_held_out_rows(spark):
    s, y, p = held_out(spark, "op5_quality", "quality")
    assert auc(s, y) > 0.99
    assert (p[y == 1] == 1).mean() > 0.99
    assert (p[y == 0] == 0).mean() > 0.95
    assert ((s >= 0.3) == p).all()
    assert ((s >= 0) & (s <= 1)).all()


def test_toxicity_on_held_out_rows(spark):
    s, y, p = held_out(spark, "op8_toxicity", "toxic")
    assert auc(s, y) > 0.97
    assert (p[y == 1] == 1).mean() > 0.9
    assert (p[y == 0] == 1).mean() < 0.01
    assert ((s >= 0.5) == p).all()


@pytest.mark.parametrize("name", ["op5_quality", "op8_toxicity"])
def test_every_row_is_scored_and_reruns_agree(spark, name):
    import zlib

    d = f"{DATA}/sf0.001"
    a, b = ({r["doc_id"]: (r["score"], r["held_out"]) for r in queries.QUERIES[name](spark, d).collect()} for _ in range(2))
    assert a == b
    assert set(a) == {r["doc_id"] for r in queries.table(spark, d, "documents").collect()}
    assert all(h == (zlib.crc32(str(k).encode()) % 5 == 0) for k, (_, h) in a.items())


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_held_out_labels_change_nothing(spark, kind):
    d = f"{DATA}/sf0.001"
    docs, labels = queries.table(spark, d, "documents"), queries.table(spark, d, "labels")
    other = labels.withColumns({c: F.when(queries.fold() == 0, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    scores = []
    for known in (labels, other):
        model = kind.learn(docs, known, "quality" if kind is quality else "toxic", queries.fold() != 0)
        scores.append({r["doc_id"]: r["score"] for r in kind.score(docs, model).collect()})
    assert scores[0] == scores[1]


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_odd_rows(spark, odd, none, kind):
    labels = spark.createDataFrame([(5, 1), (5, 0), (3, 0), (7, 1), (8, 0), (None, 1), (9, None), (99, 1), (13, 1)], "doc_id long, y int")
    model = kind.learn(odd, labels, "y", F.lit(True))
    out = kind.score(odd, model)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["score"]
    rows = out.collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (7, 8)}) == 1
    assert kind.score(none, model).count() == 0


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_no_labels_or_one_kind_of_label(spark, odd, kind):
    empty = spark.createDataFrame([], "doc_id long, y int")
    assert {r["score"] for r in kind.score(odd, kind.learn(odd, empty, "y", F.lit(True))).collect()} == {0.5}
    one = spark.createDataFrame([(13, 1), (14, 1)], "doc_id long, y int")
    assert all(r["score"] > 0.5 for r in kind.score(odd, kind.learn(odd, one, "y", F.lit(True))).collect())


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (3000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.fit(x, y)
    assert (1, 0) in model.pairs
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.9


def plain_features(text):
    """All features by counting, from bytes and words."""
    raw = text.encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w]
    lower = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    share = lambda a, b: a / b if b else 0.0
    letter = lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
    digit = lambda c: 48 <= c <= 57
    mark = lambda c: 33 <= c < 127 and not letter(c) and not digit(c)
    stop = lambda c: c in b".,;:'\"-?()"
    n = lambda f: sum(map(f, raw))
    runs = [tuple(lower[i : i + 3]) for i in range(len(lower) - 2)] if len(lower) >= 3 else ([tuple(lower)] if lower else [])
    lines = [tuple(sorted(w for w in re.split(rb"[\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in x)) if w)) for x in raw.split(b"\n")]
    return [
        math.log1p(len(raw)), math.log1p(len(words)), share(len(raw), len(words)), share(n(lambda c: 65 <= c <= 90), n(lambda c: letter(c) and c < 128)), share(n(digit), len(raw)), share(n(mark), len(raw)),
        share(n(lambda c: mark(c) and not stop(c)), len(raw)), share(n(lambda c: c >= 128), len(raw)), share(n(lambda c: c in b" \t\n\x0b\x0c\r"), len(raw)),
        share(sum(mark(a) and a == b for a, b in zip(raw[1:], raw, strict=False)), len(words)), share(len(words), len(lines)), share(len(set(lower)), len(lower)), share(len(set(runs)), len(runs)),
        share(len(set(lines)), len(lines)), share(sum(all(map(letter, w)) for w in words), len(words)), share(n(stop), len(words)),
    ]


FEATURE_TEXTS = ["The quick, BROWN fox!! 42\nThe quick fox\n\nThe quick, BROWN fox!! 42", "", " \n\t", "one", "é ü É", "a b\nB a\n", "--- ... !!! $$", "x1 2y 33\r\nX1", "w " * 500 + "\n" * 7]


def test_all_features_are_as_counted(spark):
    texts = FEATURE_TEXTS + [r["text"] for r in queries.table(spark, f"{DATA}/sf0.001", "documents").limit(60).collect()]
    raw = [t.encode() for t in texts]
    x = quality.features(np.frombuffer(b"".join(raw), dtype=np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])])
    assert x.shape == (len(texts), len(quality.FEATURES))
    for t, row in zip(texts, x, strict=True):
        assert row.tolist() == pytest.approx(plain_features(t)), t[:40]


def test_scores_are_sums_of_table_entries(spark):
    d = f"{DATA}/sf0.001"
    docs = queries.table(spark, d, "documents")
    model = quality.learn(docs, queries.table(spark, d, "labels"), "quality", queries.fold() != 0)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.op5_quality(spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        x = plain_features(texts[r["doc_id"]])
        bins = [sum(c <= v for c in cuts.tolist()) for cuts, v in zip(model.cuts, x, strict=True)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, bins, strict=True))
        total += sum(t[model.coarse[i][bins[i]], model.coarse[j][bins[j]]] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        # A feature may lie on a cut and be rounded to its other side.
        near = any(abs(c - v) < 1e-12 * max(1, abs(v)) for cuts, v in zip(model.cuts, x, strict=True) for c in cuts.tolist())
        assert near or r["score"] == pytest.approx(1 / (1 + math.exp(-total)))


def plain_ftrl(rows, y):
    """FTRL-proximal a coordinate at a time, over dictionaries."""
    z, n, bias = defaultdict(float), defaultdict(float), "bias"

    def weight(k):
        l1 = 0.0 if k == bias else toxicity.L1
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((toxicity.BETA + math.sqrt(n[k])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for at, label in zip(rows, y, strict=True):
            w = {k: weight(k) for k in [*at, bias]}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
            g *= toxicity.POSITIVE if label else 1
            for k in w:
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / toxicity.ALPHA * w[k]
                n[k] += g * g
    return {k: v for k in list(z) if (v := weight(k))}


def plain_terms(text):
    """The hashes of a text's terms, a text at a time."""
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode())

    def h(w):
        return int(bytetext.hashes(np.frombuffer(w, dtype=np.uint8), np.array([0]), np.array([len(w)]))[0])

    mixed = lambda v: int(bytetext.mix(np.array([v % 2**64], dtype=np.uint64))[0])
    own = [h(w) for w in words]
    out = own + [mixed(h(w[: toxicity.STEM]) ^ 0xA24BAED4963EE407) for w in words if len(w) > toxicity.STEM]
    for gap, salt in ((1, 0x2545F4914F6CDD1D), (2, 0x9FB21C651E98DF25)):
        out += [mixed(a * salt + b) for a, b in zip(own, own[gap:], strict=False)]
    return sorted({x >> (64 - toxicity.BITS) for x in out})


def test_toxicity_is_ftrl_over_terms(spark):
    d = f"{DATA}/sf0.001"
    docs, labels = queries.table(spark, d, "documents"), queries.table(spark, d, "labels")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = labels.filter(queries.fold() != 0).orderBy(F.xxhash64(F.lit("order"), "doc_id")).collect()
    at = {k: plain_terms(t) for k, t in texts.items()}
    w = plain_ftrl([at[r["doc_id"]] for r in known], [r["toxic"] for r in known])
    for r in queries.op8_toxicity(spark, d).collect():
        total = w.get("bias", 0.0) + sum(w.get(k, 0.0) for k in at[r["doc_id"]])
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-6)


def test_what_the_driver_learns_from_is_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "same words again"), *((5, f"row {i} of one id") for i in range(300))], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(1, 0), (5, 1)], "doc_id long, y int")
    seen = {}
    monkeypatch.setattr(quality, "LABELLED", 40)
    monkeypatch.setattr(toxicity, "COORDINATES", 200)
    for kind in (quality, toxicity):
        monkeypatch.setattr(kind, "fit", lambda x, y, kind=kind, real=kind.fit: seen.update({kind: (x, y)}) or real(x, y))
        kind.learn(docs, labels, "y", F.lit(True))
    assert len(seen[quality][1]) == 40
    assert 0 < sum(map(len, seen[toxicity][0])) <= 200
    assert len(seen[toxicity][0]) > 5


def test_ftrl_keeps_few_weights():
    rng = random.Random(1)
    rows = [np.unique([rng.randrange(2, 5000) for _ in range(40)] + ([1] if i % 4 == 0 else [])) for i in range(1500)]
    at, w, bias = toxicity.fit(rows, np.array([float(i % 4 == 0) for i in range(1500)]))
    assert len(at) < 500
    assert w[at == 1][0] == max(w)
    assert bias < 0


def test_word_hashes_know_words_in_any_case_and_place():
    texts = ["Alpha beta", "xx ALPHA  beta", "alphabeta", "", "é" * 300_000 + " alpha"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.r_[0, np.cumsum([len(t.encode()) for t in texts])]
    starts, ends = bytetext.words(data, offsets)
    h = bytetext.hashes(data, starts, ends)
    n = bytetext.counts_in(starts, offsets)
    assert n.tolist() == [2, 3, 1, 0, 2]
    a, b, _, a2, b2, ab, _, a3 = h.tolist()
    assert a == a2 == a3
    assert b == b2
    assert len({a, b, ab}) == 3
