"""A key holding a third of the rows: results stay whole and exact, plans pre-aggregate."""

import contextlib
import io

from pyspark.sql import functions as F

from farelane.functions.calendar import with_calendar
from farelane.operators import demand
from farelane.operators import features as feat
from farelane.plans import local_models as lm
from farelane.sources import adapters as ad


def _hot(spark, sf):
    ev = ad.trips_ev(spark, sf)
    # every third trip shares one id (and so one bucket) and one pickup hour
    return ev.withColumns({
        "trip_id": F.when(F.col("trip_id") % 3 == 0, F.lit(42)).otherwise(F.col("trip_id")),
        "pickup_datetime": F.when(F.col("trip_id") % 3 == 0, F.lit("2024-01-05 08:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("pickup_datetime")),
    })


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_bucket_models_are_exact(spark, sf):
    t = feat.fare_features(_hot(spark, sf), "hour")
    n = t.count()
    b = feat.with_bucket(t, 4).groupBy("bucket").count().collect()
    assert max(r["count"] for r in b) >= n / 3  # the hot bucket really is hot
    mom = lm.lr_moments(feat.with_bucket(t, 4), ["trip_meters", "trip_time"], feat.LABEL)
    assert sorted((r.bucket, r.n) for r in mom.collect()) == sorted((r.bucket, r["count"]) for r in b)
    p = _plan(mom)
    assert "partial_covar_pop" in p and "partial_count" in p  # map-side combine before the shuffle
    trees = lm.fit_local_trees(t, feat.LOCAL_FEATURES, feat.LABEL, 4, 3)
    roots = {r.bucket: r.n for r in trees.nodes(spark).where("level = 0").collect()}
    assert roots == {r.bucket: float(r["count"]) for r in b}
    total = trees.nodes(spark).where("feature IS NULL").agg(F.sum("n")).first()[0]
    assert total == n  # every row lands in exactly one leaf


def test_hot_hour_counts_whole(spark, sf):
    c = with_calendar(_hot(spark, sf))
    hs = demand.hourly_stats(c)
    assert hs.agg(F.sum("hourly_numTrips")).first()[0] == c.count()
    hot = hs.where("pickupdate = DATE'2024-01-05' AND pickuphour = 8").first().hourly_numTrips
    assert hot >= c.count() / 3
    assert "partial_count" in _plan(hs)
