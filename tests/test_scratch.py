"""Scratch tables that a step owns are gone when it ends, also when it fails."""

import os

import pytest
from pyspark.sql import functions as F

from farelane.operators import features as feat
from farelane.plans import global_models as gm
from farelane.plans import local_models as lm
from farelane.session import ensure_checkpoint_dir, materialize, scratch_scope
from farelane.sources import adapters as ad


def _tables(spark):
    folder = ensure_checkpoint_dir(spark).replace("file:", "", 1) + "/tables"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_fits_and_correlations_leave_nothing(spark, sf):
    rows = feat.fare_features(ad.trips_ev(spark, sf), "hour")
    context = materialize(rows.groupBy("hour").agg(F.count("*").alias("n_trips")))
    before = _tables(spark)
    models = lm.fit_local_trees(rows, feat.LOCAL_FEATURES, feat.LABEL, 2, 2)
    assert lm.score_tree_ensemble(models, rows).count() > 0
    assert gm.global_nodes(rows, ["trip_time", "hour"], depth=2).trees == 1
    assert gm.global_rmse(rows, ["trip_time", "hour"], "gbt", depth=2, stages=(1,)).first().rmse_1 > 0
    assert feat.correlation_with_context(rows, context, ["trip_time"], ["n_trips"], keys=("hour",)).count() == 4
    assert _tables(spark) == before


def test_a_failing_step_leaves_nothing_and_outer_tables_stay(spark):
    outer = materialize(spark.range(5))
    before = _tables(spark)
    with pytest.raises(ValueError, match="stop"):
        with scratch_scope(spark):
            materialize(spark.range(3))
            with scratch_scope(spark):
                materialize(spark.range(4))
            assert len(_tables(spark)) == len(before) + 1
            raise ValueError("stop")
    assert _tables(spark) == before and outer.count() == 5
