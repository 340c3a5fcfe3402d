import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm import embedding_whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in rows], SCHEMA)


def whitened(df, **kw):
    rows = W.usable(df)
    model = W.fit(rows, **kw)
    return model, W.whiten(rows, model, W.identity_error(rows, model) if model else 0.0)


def brute(rows, k=8):
    """By the definition: whole numbers, centred covariance, eigenvectors."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(sum((n * c - t) ** 2 for c, t in zip(r, s))) for r in x]
    a = np.array([[(n * c - t) / n for c, t in zip(r, s)] for r in x], float)
    cov = a.T @ a / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return n, deviation, a @ v / np.sqrt(e), e / np.trace(cov)


def test_equals_the_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate((rng.normal(size=(300, 12)) * np.geomspace(3, 0.05, 12)) @ rng.normal(size=(12, 12)) + 5)]
    model, out = whitened(vectors(spark, rows).repartition(7))
    n, deviation, want, explained = brute(rows)
    got = out.orderBy("vec_id", "component").toPandas()
    assert got.n.unique().tolist() == [n] and got.deviation.tolist()[::8] == deviation
    np.testing.assert_allclose(got.whitened.to_numpy().reshape(-1, 8), want, atol=1e-7)
    np.testing.assert_allclose(got.explained[:8], explained, rtol=1e-9)
    assert model.orthogonality < 1e-12 and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    w = got.whitened.to_numpy().reshape(-1, 8)
    assert np.abs(w.T @ w / n - np.eye(8)).max() < 1e-9


def test_nearly_dependent_columns(spark):
    """Eigenvalues eleven digits apart keep their own precision, as no covariance matrix is decomposed."""
    rng = np.random.default_rng(5)
    base = rng.integers(-2**22, 2**22, size=(200, 3)) * 1.0
    small = rng.integers(-2, 3, size=200)
    rows = [(i, [a, b, c, a + b + s / 1024]) for i, ((a, b, c), s) in enumerate(zip(base, small))]
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "vec_id long, embedding array<double>")
    model, out = whitened(df, components=4)
    assert len(model.eigenvalues) == 4 and len(model.factors) >= 2
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows], float)
    s = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    np.testing.assert_allclose(np.sqrt(model.eigenvalues * len(rows)), s, rtol=1e-4)
    assert out.first().identity_error < 1e-4


def test_lost_rank_gives_fewer_components(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [a, b, 2 * a, 7, a - b]) for i, (a, b) in enumerate(rng.integers(-50, 50, size=(90, 2)))]
    model, out = whitened(vectors(spark, rows))
    assert len(model.eigenvalues) == 2 and out.count() == 180 and out.first().identity_error < 1e-9
    np.testing.assert_allclose(out.orderBy("vec_id", "component").toPandas().explained[:2], brute(rows, 2)[3], rtol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [])], [(1, [1, 2, 3])], [(i, [4, 5]) for i in range(9)]])
def test_no_rows_without_spread(spark, rows):
    model, out = whitened(vectors(spark, rows))
    assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i % 20, v) for i, v in enumerate(rng.normal(size=(40, 3)))] + [(None, [0.1, 0.2, 0.3]), (None, [0.1, 0.2, 0.3])]
    bad = [(50, None), (51, [1, None, 2]), (52, [1, float("nan"), 2]), (53, [1, float("inf"), 2]), (54, [1, 2]), (55, [1e38, 1, 1]), (56, [1, float("-inf"), 2])]
    df = vectors(spark, good + bad).withColumns({c: F.lit("clash") for c in ("x", "v", "k", "m", "n", "component")})
    _, out = whitened(df)
    got = out.toPandas()
    assert len(got) == 3 * len(good) and got.n.unique().tolist() == [len(good)]
    assert got.vec_id.isna().sum() == 6 and not set(got.vec_id.dropna()) & {50, 51, 52, 53, 54, 55, 56}
    _, deviation, want, _ = brute(good, 3)
    assert sorted(got.deviation[got.component == 1]) == sorted(deviation)
    np.testing.assert_allclose(np.sort(got.whitened[got.component == 2]), np.sort(want[:, 1]), atol=1e-9)


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [x, i]) for i, x in enumerate([0, 1e6, 2e6, 3.5e6])]
    got = {r.vec_id: r.deviation for r in whitened(spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "vec_id long, embedding array<double>"))[1].collect()}
    _, deviation, _, _ = brute(rows, 2)
    assert got == {i: d if d < 2**63 else None for (i, _), d in zip(rows, deviation)} and None in got.values()
