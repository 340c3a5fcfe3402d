"""Operator 8: recall and exact scores against brute force."""

import numpy as np
from pyspark.sql import functions as F

from farelane.llm import learned_partitions as L


def _brute(ids, v, queries, k=5):
    u = v / np.sqrt((v * v).sum(axis=1))[:, None]
    out = {}
    for q in queries:
        i = int(np.flatnonzero(ids == q)[0])
        s = u @ u[i]
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def _search(df, **kw):
    out = {}
    for r in L.search(L.usable(df), F.col("vec_id") % 50 == 0, **kw).collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [x[i] for i in sorted(x)] for q, x in out.items()}


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = _brute(ids, v, [int(i) for i in ids if i % 50 == 0])
    got = _search(df, block_rows=150, block_queries=10)
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    hits = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want])
    assert hits >= 0.9, hits
    for q, found in got.items():
        i = int(np.flatnonzero(ids == q)[0])
        for j, s in found:
            x = v[int(np.flatnonzero(ids == j)[0])]
            assert abs(s - x @ v[i] / np.sqrt((x @ x) * (v[i] @ v[i]))) < 1e-12
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_odd_vectors_and_ties(spark):
    one = [1.0, 0.0]
    rows = [(i, one) for i in range(0, 120)] + [(200, None), (201, [0.0, 0.0]), (202, [float("nan"), 1.0]), (203, [float("inf"), 1.0]), (204, [None, 1.0]),
            (205, [1.0, 2.0, 3.0]), (None, one), (250, [0.0, 1.0]), (250, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"v": F.lit("clash"), "part": F.lit(1)})
    got = _search(df)
    assert set(got) == {0, 50, 100, 250}
    assert [i for i, _ in got[50]] == [0, 1, 2, 3, 4] and [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and all(s == 1.0 for _, s in got[0])
    assert all(i != 250 for i, _ in got[250])


def test_few_and_no_candidates(spark):
    few = spark.createDataFrame([(50, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [i for i, _ in _search(few)[50]] == [1, 2]
    assert _search(few.where("vec_id = 50")) == {}
    assert _search(few.where("false")) == {}


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 16)) * 4
    x = L._unit(np.concatenate([c + rng.normal(size=(100, 16)) for c in centres]))
    near = L.neighbour_graph(x, 10)
    part = L.balanced_parts(near, 8)
    assert np.bincount(part).max() <= 107 and (part[near] == part[:, None]).mean() > 0.8


def test_recall_beyond_the_sample(spark, monkeypatch):
    """30,000 rows, of which the model saw about 8,192: recall of rows and queries that it never saw."""
    rng = np.random.default_rng(2)
    n, d = 30_000, 64
    centres = rng.normal(size=(300, d))
    v = (centres[rng.integers(0, 300, n)] + 0.7 * rng.normal(size=(n, d))).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>").repartition(8)
    fitted = []
    fit = L.fit
    monkeypatch.setattr(L, "fit", lambda sample, *a: fitted.append(len(sample)) or fit(sample, *a))
    ids, v = np.arange(n), v.astype(float)
    want = _brute(ids, v, range(0, n, 50))
    got = _search(df, block_rows=700, block_queries=100)
    assert L.SAMPLE_ROWS / 2 < fitted[0] <= 2 * L.SAMPLE_ROWS < n and set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]
    print(f"recall over {n} rows, {fitted[0]} of them in the sample: {np.mean(hits):.3f}")
    assert np.mean(hits) >= 0.9


def test_sample_is_bounded_under_a_hot_id(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(7, x.tolist()) for x in rng.normal(size=(3000, 4))] + [(8, [1.0, 2.0, 3.0, 4.0])] * 3000 + [(100, [1.0, 2.0, 3.0, 4.5])]
    seen = []
    fit = L.fit
    monkeypatch.setattr(L, "fit", lambda sample, *a: seen.append(len(sample)) or fit(sample, *a))
    got = _search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), sample_rows=200)
    assert 50 < seen[0] <= 400 and [i for i, _ in got[100]] == [8] * 5
