"""Fitted Spark ML trees as node tables: walking them gives the pipeline's own predictions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.operators import features as feat
from farelane.plans import global_models as gm
from farelane.plans.model_tables import node_table
from farelane.sources import adapters as ad


@pytest.mark.parametrize("kind,depth", [("dt", 5), ("dt", 0), ("gbt", 3)])
def test_walk_equals_pipeline(spark, sf, kind, depth):
    train, test = feat.train_test_split(feat.fare_features(ad.trips_ev(spark, sf)))
    model = gm.fit_global(train, feat.GLOBAL_FEATURES, kind, depth=depth)
    nodes = node_table(model.stages[-1], feat.GLOBAL_FEATURES)
    both = nodes.score(gm.score(model, test).drop("features").withColumnRenamed("prediction", "want"), "got")
    diff = both.agg(F.max(F.abs(F.col("want") - F.col("got"))).alias("d"), F.count("got").alias("n")).first()
    assert diff.n == test.count() and diff.d < 1e-9
    assert nodes.trees == (20 if kind == "gbt" else 1)


def test_nodes_add_up(spark, sf):
    nodes = {r.node: r for r in gm.global_nodes(feat.fare_features(ad.trips_ev(spark, sf)), feat.GLOBAL_FEATURES).frame(spark).collect()}
    train, _ = feat.train_test_split(feat.fare_features(ad.trips_ev(spark, sf)))
    total = train.agg(F.count("*").alias("n"), F.sum(feat.LABEL).alias("s")).first()
    assert nodes[1].n == total.n and abs(nodes[1].s - total.s) < 1e-6
    for i, r in nodes.items():
        assert abs(r.value - r.s / r.n) < 1e-9 and (r.feature_name is None) == (2 * i not in nodes)
        if r.feature_name:
            a, b = nodes[2 * i], nodes[2 * i + 1]
            assert a.n + b.n == r.n and abs(a.s + b.s - r.s) < 1e-6
            assert abs(r.gain - (a.s**2 / a.n + b.s**2 / b.n - r.s**2 / r.n)) < 1e-6 * max(1, r.gain)


def test_first_trees_alone(spark, sf):
    """The staged errors are those of the sums of the first trees, and fall."""
    rows = feat.fare_features(ad.trips_ev(spark, sf))
    r = gm.global_rmse(rows, feat.GLOBAL_FEATURES, "gbt", depth=3, stages=(1, 2, 20)).first()
    assert r.rmse_1 > r.rmse_2 > r.rmse_20 and np.isclose(r.rmse_20, r.rmse) and r.beats_mean
