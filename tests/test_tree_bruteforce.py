"""Level-wise Spark trees equal a brute-force greedy tree on a small fixture."""

import hashlib
import math
import os
from contextlib import nullcontext
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import functions as F

from farelane.operators import features as feat
from farelane.plans import local_models as lm
from farelane.plans import quantiles as qt
from farelane.plans import staged_merge as sm
from farelane.session import materialize
from farelane.sources import adapters as ad

FEATS = ["trip_time", "trip_meters", "hour", "isWeekend"]


def _brute(X, y, depth, min_gain=lm.MIN_GAIN):
    """Greedy SSE tree over pre-binned X: {node: (n, sum, feature, bin)} with heap ids."""
    out = {}
    frontier = {1: np.arange(len(y))}
    for level in range(depth + 1):
        nxt = {}
        for node, idx in frontier.items():
            n, s = float(len(idx)), float(y[idx].sum())
            best = None
            if level < depth:
                for f in range(X.shape[1]):
                    for b in sorted(set(X[idx, f].tolist())):
                        left = idx[X[idx, f] <= b]
                        nl = len(left)
                        if nl == 0 or nl == len(idx):
                            continue
                        sl = float(y[left].sum())
                        sr, nr = s - sl, n - nl
                        gain = sl * sl / nl + sr * sr / nr - s * s / n
                        if gain > min_gain and (best is None or gain > best[0] + 1e-9 * abs(best[0])):
                            best = (gain, f, b)
            out[node] = (n, s, None if best is None else best[1], None if best is None else best[2])
            if best is not None:
                _, f, b = best
                nxt[2 * node] = idx[X[idx, f] <= b]
                nxt[2 * node + 1] = idx[X[idx, f] > b]
        frontier = nxt
    return out


def _bins(part, models):
    return lm._binned([part[f].to_numpy(dtype=float) for f in models.features], models.edges)


def test_trees_match_bruteforce(spark, sf):
    tr, _ = feat.train_test_split(feat.fare_features(ad.trips_ev(spark, sf), "hour"))
    depth, bins, nb = 3, 16, 2
    models = lm.fit_local_trees(tr, FEATS, feat.LABEL, nb, depth, bins)
    pdf = feat.with_bucket(tr, nb).toPandas()
    got = {(r.bucket, r.node): (r.n, r.s, r.feature, r.bin) for r in models.nodes(spark).collect()}
    for b in range(nb):
        part = pdf[pdf.bucket == b]
        want = _brute(_bins(part, models), part[feat.LABEL].to_numpy(dtype=float), depth)
        mine = {node: v for (bb, node), v in got.items() if bb == b}
        assert set(mine) == set(want), b
        for node, (n, s, f, bn) in want.items():
            gn, gs, gf, gb = mine[node]
            assert gn == n and abs(gs - s) < 1e-6 * max(1.0, abs(s))
            assert (gf, gb) == (f, bn), (b, node)


def _copies(keys, tree):
    """Poisson(1) copies by the plain rule: 8 of an MD5's hex digits as a share, inverted."""
    out = []
    for k in keys:
        digits = hashlib.md5(f"bootstrap:{tree // 4}:{'null' if k is None else k}".encode()).hexdigest()
        u, n, upto = int(digits[8 * (tree % 4):8 * (tree % 4) + 8], 16) / 2**32, 0, math.exp(-1)
        while u >= upto and n < 13:
            n += 1
            upto += math.exp(-1) / math.factorial(n)
        out.append(n)
    return np.array(out)


def test_bagged_trees_equal_trees_on_written_copies(spark, sf):
    """Copies weighted inside the task grow the same trees as copies written as rows."""
    tr, _ = feat.train_test_split(feat.fare_features(ad.trips_ev(spark, sf), "hour"))
    tr = feat.with_bucket(tr.withColumn("y", F.round(feat.LABEL)), 2)
    n_trees, depth, bins = 3, 3, 8
    bagged = lm.fit_trees(tr, FEATS, "y", depth, bins, "bucket", 2, trees=n_trees, key="trip_id")
    pdf = tr.toPandas()
    for b in range(2):
        part = pdf[pdf.bucket == b]
        X = _bins(part, bagged)
        for t in range(n_trees):
            w = _copies(part.trip_id, t)
            want = _brute(np.repeat(X, w, axis=0), np.repeat(part.y.to_numpy(dtype=float), w), depth)
            g = b * n_trees + t
            mine = {node: (bagged.n[g, node], bagged.s[g, node]) for node in np.flatnonzero(bagged.n[g] > 0)}
            assert mine == {node: (n, s) for node, (n, s, _, _) in want.items()}


def test_copies_have_mean_and_variance_one(spark):
    """Copies of the library equal the plain ones, and are Poisson(1) and unrelated from tree to tree."""
    n, trees = 20_000, 6
    df = spark.range(0, n * 1000, 1000).select(F.col("id").alias("trip_id"))
    hashes = df.orderBy("trip_id").select(lm.bootstrap_hashes("trip_id", trees).alias("h")).toPandas().h
    w = lm.poisson_weights(np.frombuffer(b"".join(hashes), ">u4").reshape(n, -1)[:, :trees]).astype(float)
    for t in range(trees):
        assert w[:50, t].tolist() == _copies(range(0, 50_000, 1000), t).tolist()
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.04 and w.max() >= 6
    assert np.abs(np.corrcoef(w.T) - np.eye(trees)).max() < 0.03


def test_missing_keys_draw_copies_too(spark):
    df = spark.createDataFrame([(None, float(i), float(i > 5)) for i in range(12)], "trip_id long, x double, y double").withColumn("bucket", F.lit(0))
    models = lm.fit_trees(df, ["x"], "y", 1, 4, trees=2, key="trip_id")
    assert models.n[:, 1].tolist() == [12.0 * _copies([None], t)[0] for t in range(2)]


def test_histograms_merge_in_stages(spark, sf, monkeypatch):
    """Many tasks and a small fan-in: several stages, the same tree; no group holds more than the fan-in's states."""
    tr, _ = feat.train_test_split(feat.fare_features(ad.trips_ev(spark, sf), "hour"))
    rows = tr.withColumn("bucket", F.lit(0)).withColumn("y", F.round(feat.LABEL))
    want = lm.fit_trees(rows, FEATS, "y", 3, 16)
    seen = []
    real = sm.merge_in_stages

    def counted(states, keys, parts, merge):
        seen.append(parts)
        out = real(states, keys, parts, merge, 2)
        assert out.groupBy(*keys).agg(F.countDistinct("part").alias("n")).agg(F.max("n")).first()[0] <= 2
        return out

    monkeypatch.setattr(lm, "merge_in_stages", counted)
    monkeypatch.setattr(qt, "merge_in_stages", counted)
    monkeypatch.setattr(lm, "materialize", lambda df: materialize(df.repartition(40)))
    got = lm.fit_trees(rows, FEATS, "y", 3, 16)
    assert len(seen) == 4 and min(seen) > 4
    for a in ("n", "s", "feature", "bin"):
        assert (getattr(got, a) == getattr(want, a)).all(), a


def test_rows_with_null_or_nan_are_left_out(spark):
    """Half the labels null, one feature NaN: fits see the complete rows alone."""
    rows = [(i, float(i % 10), 2.0 * (i % 10) + 1 if i % 2 else None) for i in range(200)] + [(900, float("nan"), 7.0), (901, None, 7.0)]
    df = spark.createDataFrame(rows, "trip_id long, x double, y double").withColumn("bucket", F.lit(0))
    lr = {r.term: r.coef for r in lm.fit_local_lr(df, ["x"], "y").collect()}
    assert abs(lr["x"] - 2) < 1e-9 and abs(lr["intercept"] - 1) < 1e-9
    models = lm.fit_trees(df, ["x"], "y", 1, 8)
    root = models.nodes(spark).where("node = 1").first()
    assert root.n == 100 and root.feature_name == "x" and abs(root.value - np.mean([r[2] for r in rows[:200] if r[2] is not None])) < 1e-9
    scored = {r.trip_id: r.prediction for r in lm.score_tree_ensemble(models, df).collect()}
    assert scored[900] is None and scored[901] is None and scored[3] is not None


def test_an_outlier_does_not_hide_a_split(spark):
    rows = [(i, float(i % 100), 1.0 if i % 100 < 50 else 5.0) for i in range(1000)] + [(5000, 1e6, 5.0)]
    df = spark.createDataFrame(rows, "trip_id long, x double, y double").withColumn("bucket", F.lit(0))
    root = lm.fit_trees(df, ["x"], "y", 1, 32).nodes(spark).where("node = 1").first()
    assert 45 <= root.threshold <= 54


def test_many_buckets_equal_few_at_once(spark, sf):
    """The same path serves 3 and 5,000 groups; a bucket's tree does not depend on the others."""
    t = feat.fare_features(ad.trips_ev(spark, sf), "hour").withColumn("bucket", (F.col("trip_id") % 5000).cast("int"))
    many = lm.fit_trees(t, FEATS, feat.LABEL, 2, 4, "bucket", 5000)
    rows = {r.bucket: r.n for r in many.nodes(spark).where("node = 1").collect()}
    assert rows == {r.bucket: r["count"] for r in t.groupBy("bucket").count().collect()}


def test_steps_in_keys_fall_evenly(spark):
    df = spark.range(0, 2_000_000, 1000).withColumnRenamed("id", "trip_id")
    train, test = feat.train_test_split(df)
    assert abs(train.count() / 2000 - 0.7) < 0.05 and train.count() + test.count() == 2000
    sizes = [r.n_rows for r in feat.bucket_sizes(df, 8).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.4 * 250
    keyed = feat.with_trip_key(spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "hvfhs_license_num string, PULocationID long"))
    assert [r.trip_id for r in keyed.collect()][0] == [r.trip_id for r in keyed.collect()][1] and keyed.select("trip_id").distinct().count() == 2


def test_holidays_follow_the_year_of_each_date(spark):
    from farelane.functions import calendar as cal

    df = spark.sql("SELECT date_add(DATE'1990-01-01', CAST(id AS INT)) AS d FROM range(18000)")
    years = df.select(F.year("d").alias("year")).distinct()
    want = {r.holiday_date for r in cal.holiday_dim(spark, years=spark.range(1989, 2042).select(F.col("id").cast("int").alias("year"))).collect()}
    days = {r.d for r in df.collect()}
    assert {r.d for r in df.where(cal.is_holiday("d")).collect()} == want & days and years.count() > 40
    flags = cal.with_demand_flags(spark.sql("SELECT DATE'1996-12-25' AS pickupdate, 9 AS pickuphour")).first()
    assert (flags.isWeekend, flags.isRushhour) == (1, 0)


def test_histograms_leave_a_task_once_whatever_the_batches(spark, monkeypatch):
    """A forest's states grow with nodes and tasks, not with Arrow batches, and rows travel as packed bins and copies."""
    n_trees, depth = 100, 5
    xs = [F.pmod(F.xxhash64("trip_id", F.lit(i)), F.lit(1000)).cast("double").alias(f"x{i}") for i in range(40)]
    df = spark.range(4000).withColumnRenamed("id", "trip_id").select("trip_id", F.lit(0).alias("bucket"), *xs)
    df = df.withColumn("y", F.col("x0") * F.col("x1") + F.col("x2"))
    twice, tables = [], []

    def counted(states, keys, parts, merge):
        if "slot" in states.columns:
            twice.append(states.groupBy("slot", "part").count().where("count > 1").count())
        return sm.merge_in_stages(states, keys, parts, merge)

    def kept(rows):
        tables.append(materialize(rows))
        return tables[-1]

    monkeypatch.setattr(lm, "merge_in_stages", counted)
    monkeypatch.setattr(lm, "materialize", kept)
    monkeypatch.setattr(lm, "scratch_scope", lambda spark: nullcontext())
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        models = lm.fit_trees(df, [f"x{i}" for i in range(40)], "y", depth, 32, "bucket", 1, trees=n_trees, key="trip_id")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert models.n[:, 1].sum() > 0 and twice == [0] * depth
    # 40 bins of 5 bits, 100 copies of about 2 bits and a label
    assert sum(os.path.getsize(urlparse(f).path) for f in tables[0].inputFiles()) < 4000 * 100


def test_a_hot_group_is_dealt_over_tasks(spark, monkeypatch):
    """Every row counts once, and the blocks of a group that holds half the rows lie in several files."""
    monkeypatch.setattr(lm, "ROWS_A_BLOCK", 500)
    spread = []

    def kept(rows):
        out = materialize(rows)
        spread.append(out.where("g = 7").groupBy(F.input_file_name()).agg(F.sum("n").alias("n")).collect())
        return out

    monkeypatch.setattr(lm, "materialize", kept)
    df = spark.range(20_000).select(F.col("id").alias("trip_id"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("bucket"),
                                    (F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 13).cast("double").alias("y"))
    models = lm.fit_trees(df, ["x"], "y", 2, 8, "bucket", 50)
    assert len(spread[0]) > 1 and sum(r.n for r in spread[0]) == 10_400 and max(r.n for r in spread[0]) < 8000
    sizes = {r.bucket: float(r["count"]) for r in df.groupBy("bucket").count().collect()}
    assert {g: n for g, n in enumerate(models.n[:, 1].tolist()) if n} == sizes


def _trips_and_context(spark):
    """Rows of 40 hours, some without a group, label, feature or context; a context with gaps and an hour that comes twice."""
    rows = spark.range(6000).selectExpr(
        "id AS trip_id", "IF(id % 53 = 0, null, id % 41) AS hour", "IF(id % 59 = 0, null, id % 2) AS bucket", "double(id * 37 % 101) AS a",
        "IF(id % 61 = 0, null, id * 13 % 17) AS b", "IF(id % 67 = 0, double('NaN'), double(id * 37 % 101 + (id % 41) * (id % 41))) AS y")
    hours = spark.range(40).selectExpr("id AS hour", "IF(id = 7, null, double(id * id)) AS temp", "IF(id = 9, double('NaN'), double(id % 6)) AS rain",
                                       "id % 2 = 0 AS even")
    return rows, hours.unionByName(hours.where("hour = 11")).withColumn("even", F.col("even").cast("int"))


def test_context_at_its_own_grain_gives_the_same_trees(spark):
    rows, context = _trips_and_context(spark)
    features = ["temp", "a", "even", "b", "rain"]
    for trees in (0, 3):
        want = lm.fit_trees(rows.join(context, "hour"), features, "y", 3, 8, "bucket", 2, trees=trees, key="trip_id")
        got = lm.fit_trees(rows, features, "y", 3, 8, "bucket", 2, trees=trees, key="trip_id", context=context, keys=("hour",))
        assert want.n[:, 1].min() > 1000 and (want.feature >= 0).sum() > 6
        assert [e.tolist() for e in got.edges] == [e.tolist() for e in want.edges]
        for name in ("feature", "bin", "n"):
            assert (getattr(got, name) == getattr(want, name)).all(), name
        assert np.allclose(got.s, want.s) and np.allclose(got.gain, want.gain)


def test_places_are_counted_in_parts(spark, monkeypatch):
    rows, context = _trips_and_context(spark)
    side = context.where("temp IS NOT NULL AND NOT isnan(rain)").dropDuplicates(["hour"]).selectExpr("hour AS place", "temp", "rain")
    df = rows.where("hour IS NOT NULL AND hour < 40 AND hour NOT IN (7, 9)")
    want, _ = qt.edges_and_shares(df.join(side.withColumnRenamed("place", "hour"), "hour"), ["a", "temp", "rain"], 16, "bucket")
    monkeypatch.setitem(qt.edges_and_shares.__globals__, "PLACES_AT_ONCE", 100)
    got, (values, sizes) = qt.edges_and_shares(df.withColumn("place", F.col("hour")), ["a"], 16, "bucket", side=side)
    assert [e.tolist() for e in got] == [e.tolist() for e in want] and len(got[1]) > 10
    held = {r.bucket: r.n for r in df.where("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    assert dict(zip(values.tolist(), sizes.tolist())) == held


def test_votes_send_no_context_column_with_a_trip(spark, sf, monkeypatch):
    import __spark_entry__ as entry

    seen = []

    def recorded(df, columns, *more, **named):
        seen.append(([entry.VOTE_FEATURES[int(c[1:])] for c in columns], df.columns))
        return qt.edges_and_shares(df, columns, *more, **named)

    monkeypatch.setattr(lm, "edges_and_shares", recorded)
    votes = entry.queries()["feature_votes_small"](spark, sf).count()
    assert votes == len(entry.VOTE_DOMAIN)
    assert seen[0][0] == ["PULocationID", "DOLocationID", "trip_time", *entry.FARE_PARTS, "trip_meters"]
    assert len(seen) == 1 and len(seen[0][1]) == len(seen[0][0]) + 4  # group, hashes, label and place
