"""Moments folded in tasks by key and as a whole, against numpy over all rows."""

import numpy as np
from pyspark.sql import functions as F

from farelane.operators import moments as mo
from farelane.session import materialize


def _rows(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(k), None if k == 3 else f"h{k % 4}", float(a) + 1e6, float(b)) for k, a, b in zip(rng.integers(0, 40, n), rng.normal(size=n), rng.exponential(size=n))]


def _want(x):
    d = x - x.mean(axis=0)
    return float(len(x)), x.mean(axis=0), (d.T @ d)[np.triu_indices(x.shape[1])]


def _same(got, want):
    for a, b in zip(got, want):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-6)


def test_whole(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k int, h string, a double, b double").repartition(9)
    _same(mo.moments(df, ["a", "b"]), _want(np.array([r[2:] for r in rows])))
    assert mo.moments(df.where("false"), ["a", "b"])[0] == 0


def test_by_key_over_many_batches_and_hand_overs(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k int, h string, a double, b double").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for held in (5, 1000):
            got = {}
            for r in mo.keyed_moments(df, ["k", "h"], ["a", "b"], held).collect():
                got.setdefault((r.k, r.h), []).append((r.n, np.array(r.m), np.array(r.w)))
            assert set(got) == {r[:2] for r in rows if r[1] is not None}  # null keys join nothing
            for key, states in got.items():
                _same(mo.fold_all(*(np.stack([np.asarray(s[c]) for s in states]) for c in range(3))), _want(np.array([r[2:] for r in rows if r[:2] == key])))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_constants_beside_the_columns(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k int, h string, a double, b double").repartition(4)
    parts = mo.keyed_moments(df, ["k"], ["a", "b"]).withColumns({"c": F.col("k") * 2.0, "d": F.sin("k")})
    got = mo.moments_with_constants(materialize(parts), 2, ["c", "d"])
    _same(got, _want(np.array([(a, b, 2.0 * k, np.sin(k)) for k, _, a, b in rows])))
