"""The streaming hourly aggregate equals the batch one for every closed hour."""

import datetime as dt

from pyspark.sql import functions as F

from farelane.functions.calendar import with_calendar
from farelane.operators.demand import hourly_stats
from farelane.sources import adapters as ad
from farelane.streaming.demand_stream import hourly_stats_stream, read_trip_stream, write_hourly


def test_stream_matches_batch(spark, sf, tmpdir_path):
    ev = ad.trips_ev(spark, sf)
    src = f"{tmpdir_path}/in"
    ev.repartition(4).write.parquet(src)
    stream = hourly_stats_stream(read_trip_stream(spark, src, ev.schema, max_files_per_trigger=2))
    q = write_hourly(stream, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt")
    q.awaitTermination(300)
    got = spark.read.parquet(f"{tmpdir_path}/out")
    assert got.count() > 0
    batch = hourly_stats(with_calendar(ev)).select(
        F.make_timestamp("pickupyear", "pickupmonth", F.dayofmonth("pickupdate"), "pickuphour",
                         F.lit(0), F.lit(0)).alias("hour_start"),
        "hourly_numTrips", "hourly_total_time")
    g = {r.hour_start.replace(tzinfo=None): (r.hourly_numTrips, r.hourly_total_time) for r in got.collect()}
    b = {r.hour_start.replace(tzinfo=None): (r.hourly_numTrips, r.hourly_total_time) for r in batch.collect()}
    for h, v in g.items():
        assert b[h] == v
