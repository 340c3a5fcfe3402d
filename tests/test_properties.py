"""Properties of the operators that have no SQL twin (models, votes, sweeps)."""

import math

import numpy as np
from pyspark.sql import functions as F

from farelane.operators import features as feat
from farelane.plans import experiments as ex
from farelane.plans import global_models as gm
from farelane.plans import local_models as lm
from farelane.sources import adapters as ad


def _split(spark, sf, calendar="hour"):
    return feat.train_test_split(feat.fare_features(ad.trips_ev(spark, sf), calendar))


def test_split_is_a_partition(spark, sf):
    t = ad.trips_li(spark, sf)
    tr, te = feat.train_test_split(t)
    assert tr.count() + te.count() == t.count()
    assert tr.join(te, "trip_id", "left_semi").count() == 0 or \
        tr.select("trip_id").intersect(te.select("trip_id")).count() == 0


def test_one_bucket_lr_equals_global_lr(spark, sf):
    tr, _ = _split(spark, sf, "day")
    cols = ["trip_meters", "trip_time"]
    local = {r.term: r.coef for r in lm.fit_local_lr(tr, cols, feat.LABEL, 1).collect()}
    model = gm.fit_global(tr, cols, "lr").stages[-1]
    assert abs(local["intercept"] - model.intercept) < 1e-6 * max(1, abs(model.intercept))
    for c, b in zip(cols, model.coefficients):
        assert abs(local[c] - b) < 1e-6 * max(1e-3, abs(b))


def test_lr_ensemble_mean_of_predictions(spark, sf):
    tr, te = _split(spark, sf, "day")
    cols = ["trip_meters", "trip_time"]
    models = lm.fit_local_lr(tr, cols, feat.LABEL, 4)
    coefs = models.toPandas()
    row = te.limit(1).toPandas().iloc[0]
    per = [g[g.term == "intercept"].coef.iloc[0] + sum(g[g.term == c].coef.iloc[0] * row[c] for c in cols)
           for _, g in coefs.groupby("bucket")]
    got = lm.score_lr_ensemble(models, te.limit(1)).first().prediction
    assert abs(got - np.mean(per)) < 1e-6


def test_tree_ensemble_beats_mean_and_depth_sweep_monotone(spark, sf):
    tr, te = _split(spark, sf)
    trees = lm.fit_local_trees(tr, feat.LOCAL_FEATURES, feat.LABEL, 4, 4)
    mean = tr.agg(F.avg(feat.LABEL)).first()[0]
    base = gm.rmse_value(te.withColumn("prediction", F.lit(mean)))
    ens = gm.rmse_value(lm.score_tree_ensemble(trees, te))
    assert ens < base
    train_rmse = [gm.rmse_value(lm.score_tree_ensemble(trees, tr, depth=d)) for d in range(0, 5)]
    assert all(b <= a + 1e-9 for a, b in zip(train_rmse, train_rmse[1:]))


def test_tree_leaf_values_match_bucket_means(spark, sf):
    tr, _ = _split(spark, sf)
    trees = lm.fit_local_trees(tr, feat.LOCAL_FEATURES, feat.LABEL, 3, 2)
    roots = {r.bucket: (r.n, r.value) for r in trees.nodes(spark).where("level = 0").collect()}
    b = feat.with_bucket(tr, 3).groupBy("bucket").agg(F.count("*").alias("n"), F.avg(feat.LABEL).alias("m"))
    for r in b.collect():
        assert roots[r.bucket][0] == r.n and abs(roots[r.bucket][1] - r.m) < 1e-9
    # children partition their parent
    nodes = trees.nodes(spark).toPandas()
    for _, p in nodes[nodes.feature.notna()].iterrows():
        kids = nodes[(nodes.bucket == p.bucket) & (nodes.node.isin([2 * p.node, 2 * p.node + 1]))]
        assert abs(kids.n.sum() - p.n) < 1e-9


def test_feature_votes_shape(spark, sf):
    tr, _ = _split(spark, sf)
    sel = lm.select_features(tr, feat.LOCAL_FEATURES, feat.LABEL, n_buckets=3, n_trees=4, depth=3)
    votes = {r.feature: r.votes for r in lm.feature_votes(sel, feat.LOCAL_FEATURES).collect()}
    assert set(votes) == set(feat.LOCAL_FEATURES)
    assert all(0 <= v <= 3 for v in votes.values()) and sum(votes.values()) > 0


def test_forecast_rows_and_aic(spark, sf):
    from farelane.plans import forecast as fc
    lags = fc.weekly_lags(fc.weekly_counts(ad.trips_li(spark, sf), "PULocationID"))
    out = fc.forecast(lags).collect()
    series = {r.series for r in out}
    assert len(out) == 2 * len(series)
    for s in series:
        assert sum(1 for r in out if r.series == s and r.best) == 1
    for r in out:
        if r.aic is not None:
            assert math.isclose(r.aic, r.n_obs * math.log(r.rss / r.n_obs) + (4 if r.model.startswith("ar") else 0),
                                rel_tol=1e-9)


def test_size_up_first_row_is_one(spark, sf):
    log = ad.experiment_log(spark, sf)
    for fn, col, order in ((ex.size_up, "size_up", "pct"), (ex.speed_up, "speed_up", "cores")):
        rows = fn(log).orderBy("model", order).collect()
        firsts = {}
        for r in rows:
            firsts.setdefault(r.model, r[col])
        assert all(abs(v - 1.0) < 1e-12 for v in firsts.values())


def test_sweep_parallelism_logs(spark, sf):
    ev = ad.trips_ev(spark, sf).withColumn("trip_km", F.col("trip_miles") * 0.621371)
    log = ex.sweep_parallelism(ev, ["trip_km", "trip_time"], "lr", cores=[1, 2], repeats=1)
    rows = log.collect()
    assert [r.cores for r in rows] == [1, 2] and all(r.runtime >= r.runtime_no_overhead >= 0 for r in rows)
