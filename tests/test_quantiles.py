"""Mergeable quantile summaries: exact while small, bounded error beyond, the same through any tree of merges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.plans import quantiles as qt


def exact(values, bins):
    v = np.sort(values)
    return np.unique([v[-(-k * len(v) // bins) - 1] for k in range(1, bins)])


@pytest.mark.parametrize("n", [0, 1, 2, 31, 1000, 5000])
def test_exact_while_distinct_values_fit(n):
    v = np.random.default_rng(n).integers(0, 700, n).astype(float)
    ladder = qt.Ladder(1024)
    for part in np.array_split(v, 7):
        ladder.add(part)
    assert qt.at_shares(*ladder.result(), 32).tolist() == (exact(v, 32).tolist() if n else [])


@pytest.mark.parametrize("shape", ["even", "rising", "heavy", "few large"])
def test_rank_error_is_bounded(shape):
    rng = np.random.default_rng(1)
    n, cells = 300_000, 512
    v = {"even": rng.random(n), "rising": np.arange(n) * 1.0, "heavy": np.where(rng.random(n) < 0.4, 7.0, rng.random(n) * 10),
         "few large": np.concatenate([rng.random(n - 5), [1e9] * 5])}[shape]
    parts = []
    for part in np.array_split(v, 20):
        ladder = qt.Ladder(cells)
        for some in np.array_split(part, 9):
            ladder.add(some)
        parts.append(ladder.result())
        assert len(parts[-1][0]) <= cells + 1
    values, weights = qt.merged([qt.merged(parts[:11], cells), qt.merged(parts[11:], cells)], cells)
    assert weights.sum() == n and (np.diff(values) > 0).all()
    true = np.searchsorted(np.sort(v), values, "right")
    shrinks = np.log2(n / 20 / cells) + 4
    assert np.abs(true - np.cumsum(weights)).max() <= shrinks * 4 / cells * n
    if shape == "heavy":
        assert 7.0 in values


def test_edges_of_a_table(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
                                    F.lit(4.0).alias("c")).repartition(13)
    a, b, c = qt.quantile_edges(df, ["a", "b", "c"], 32, cells=1 << 15)
    assert a.tolist() == exact(np.arange(20_000.0), 32).tolist() and b.tolist() == [0, 1, 2] and c.tolist() == [4]
    near = qt.quantile_edges(df, ["a"], 32, cells=256)[0]
    assert len(near) == 31 and np.abs(near - a).max() <= 20_000 * 4 / 256 * 8
    assert [e.tolist() for e in qt.quantile_edges(df.limit(0), ["a", "b"], 4)] == [[], []]
