from __future__ import annotations

import numpy as np
import pytest

from tests.conftest import DATA
from tidemill.llm import queries, whitening


def plain(vectors, most=32):
    """Rows' places, shares and exact deviations by an eigensolver and whole numbers."""
    x = [[int(np.floor(64.0 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(most, len(sums))
    return centred @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum(), [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]


def same_up_to_signs(a, b):
    return np.allclose(a * np.sign((a * b).sum(axis=0)), b, atol=1e-7)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_an_eigensolver(spark, sf):
    rows = queries.table(spark, f"{DATA}/{sf}", "embeddings").orderBy("vec_id").collect()
    whitened, shares, deviations = plain([r["embedding"] for r in rows])
    out = queries.op13_whiten(spark, f"{DATA}/{sf}")
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    got = out.orderBy("vec_id", "component").toPandas()
    assert got["vec_id"].tolist() == [r["vec_id"] for r in rows for _ in range(32)]
    assert got["component"].tolist() == [*range(1, 33)] * len(rows)
    assert set(got["n"]) == {len(rows)}
    assert got["deviation"].tolist() == [d for d in deviations for _ in range(32)]
    assert same_up_to_signs(got["whitened"].to_numpy().reshape(-1, 32), whitened)
    assert np.allclose(got["explained"].to_numpy().reshape(-1, 32), shares, rtol=1e-9)
    assert got["identity_error"].nunique() == 1
    assert got["identity_error"][0] < 1e-10
    w = got["whitened"].to_numpy().reshape(-1, 32)
    assert np.abs(w.T @ w / len(rows) - np.eye(32)).max() < 1e-10


def test_jacobi_is_accurate_for_small_deviations_too():
    """Orthogonal columns of lengths from 1 to 1e-30, turned: an eigensolver loses all below 1e-8."""
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 8, 33):
        sizes = np.logspace(0, -30, d) if d > 1 else np.ones(1)
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        got, v = whitening.jacobi(q * sizes)
        assert np.allclose(got, sizes, rtol=1e-13)
        assert np.allclose(v.T @ v, np.eye(d), atol=1e-13)
        r = rng.normal(size=(d, d))
        got, v = whitening.jacobi(r)
        assert np.allclose(got, np.linalg.svd(r, compute_uv=False), rtol=1e-12)
        a = r @ v
        assert np.abs(a.T @ a - np.diag(got**2)).max() < 1e-12


def test_triangles_of_many_tasks_meet_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 3)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6)) * [5, 3, 1, 0.5, 9, 2]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id int, embedding array<double>").repartition(20)
    rows = df.selectExpr("vec_id", "embedding")
    sums = whitening.sums_of(rows, 6)
    r = whitening.tsqr(rows, sums)
    centred = np.floor(x * 64) + 1_000_000
    centred -= centred.mean(axis=0)
    assert r.shape == (6, 6)
    assert np.allclose(r.T @ r, centred.T @ centred, rtol=1e-10)


def test_deviations_are_exact_for_large_entries(spark):
    vectors = [[1e12, -3.5, 0.0], [2e12 + 0.25, 7.0, 1.0], [-1e12, 1.0, 2.0], [5e11, 9.0, -2.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")
    _, _, deviations = plain(vectors)
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df).collect()}
    assert got == dict(enumerate(deviations))
    assert max(deviations) > 2**63


def test_unusable_rows_go_and_others_stand_for_themselves(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    good = [(i % 7 if i % 5 else None, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 3)))]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [nan, 1.0, 1.0]), (94, [1.0, inf, 1.0]), (95, [1.0, -inf, 1.0]), (96, [1.0, 2.0]), (97, [1e300, 0.0, 0.0]), (98, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in good + good[:3] + bad], "vec_id int, embedding array<double>, n string, whitened int").repartition(3)
    got = whitening.whiten(df).collect()
    assert len(got) == 43
    assert {r["n"] for r in got} == {43}
    assert sum(r["vec_id"] is None for r in got) == 9
    whitened, _, deviations = plain([v for _, v in good + good[:3]])
    assert sorted(int(r["deviation"]) for r in got) == sorted(deviations)
    assert np.allclose(sorted(abs(r["whitened"][2]) for r in got), sorted(np.abs(whitened[:, 2])), atol=1e-9)


def test_no_variance_no_rows(spark):
    schema = "vec_id int, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [0.25, 0.5]) for i in range(9)], schema)).count() == 0
    flat = whitening.whiten(spark.createDataFrame([(i, [0.25, float(i), -float(i)]) for i in range(9)], schema)).collect()
    assert {len(r["whitened"]) for r in flat} == {1}
    assert np.isclose(sum(r["whitened"][0] ** 2 for r in flat), 9)
    assert {round(r["explained"][0], 12) for r in flat} == {1.0}


def test_equally_common_lengths_keep_the_longest(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 5.0]), (3, [1.0, 2.0, 3.0]), (4, [2.0, 2.0, 9.0])], "vec_id int, embedding array<double>")
    assert {r["vec_id"] for r in whitening.whiten(df).collect()} == {3, 4}
