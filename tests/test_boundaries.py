"""Hand-made boundary rows: hours, weekdays, holidays, ISO weeks, zero/null/NaN, drift, bad text."""

import datetime as dt
import math

from pyspark.sql import functions as F

from farelane.functions import calendar as cal
from farelane.functions import rates
from farelane.operators import context as ctx
from farelane.operators import demand
from farelane.operators import features as feat
from farelane.plans import experiments as ex
from farelane.schemas import TRIP_SCHEMA
from farelane.sources import readers as rd


def _trips(spark, rows):
    return spark.createDataFrame(rows, "trip_id long, pickup_datetime timestamp_ntz, PULocationID long, "
                                       "trip_miles double, trip_time long, base_passenger_fare double")


def test_flags_hours_and_days(spark):
    T = dt.datetime
    rows = [
        (1, T(2024, 1, 8, 5, 30), 1, 1.0, 60, 5.0),    # Mon 05h: overnight, working day -> rush
        (2, T(2024, 1, 8, 6, 0), 1, 1.0, 60, 5.0),     # Mon 06h: not overnight
        (3, T(2024, 1, 6, 15, 0), 1, 1.0, 60, 5.0),    # Sat 15h: weekend, not rush
        (4, T(2024, 1, 6, 16, 0), 1, 1.0, 60, 5.0),    # Sat 16h: rush hour
        (5, T(2024, 1, 7, 19, 59), 1, 1.0, 60, 5.0),   # Sun 19h: rush hour
        (6, T(2024, 1, 7, 20, 0), 1, 1.0, 60, 5.0),    # Sun 20h: overnight
        (7, T(2024, 1, 15, 10, 0), 1, 1.0, 60, 5.0),   # MLK day (Mon): holiday -> weekend flag
        (8, T(2024, 7, 4, 10, 0), 1, 1.0, 60, 5.0),    # Independence Day (Thu)
    ]
    got = {r.trip_id: (r.isWeekend, r.isOvernight, r.isRushhour) for r in
           cal.with_demand_flags(cal.with_calendar(_trips(spark, rows))).collect()}
    assert got == {1: (0, 1, 1), 2: (0, 0, 1), 3: (1, 0, 0), 4: (1, 0, 1), 5: (1, 0, 1), 6: (1, 1, 0),
                   7: (1, 0, 0), 8: (1, 0, 0)}


def test_iso_week_edges(spark):
    T = dt.datetime
    rows = [(1, T(2019, 12, 30, 1), 1, 1.0, 1, 1.0), (2, T(2020, 12, 31, 1), 1, 1.0, 1, 1.0),
            (3, T(2021, 1, 1, 1), 1, 1.0, 1, 1.0), (4, T(2022, 1, 3, 1), 1, 1.0, 1, 1.0)]
    df = _trips(spark, rows).select("trip_id", F.weekofyear("pickup_datetime").alias("w"),
                                    cal.week_index_linear("pickup_datetime").alias("lin"),
                                    cal.week_index_case("pickup_datetime").alias("case"),
                                    cal.week_start("pickup_datetime").alias("ws"))
    got = {r.trip_id: (r.w, r.lin, r.case, r.ws) for r in df.collect()}
    # 2019-12-30 is ISO week 1 (of 2020) but calendar year 2019
    assert got[1][:3] == (1, 1 - 4, 1)
    # 2021-01-01 is ISO week 53: index 153, equal to week 1 of 2022 (kept as in the source)
    assert got[3][:3] == (53, 53 + 2 * 52 - 4, 153)
    assert got[4][2] == 1 + 152
    assert got[3][3] == dt.date(2020, 12, 28)


def test_holiday_rules(spark):
    h = {(r.holiday_date, r.holiday_name) for r in cal.holiday_dim(spark, 2021, 2023).collect()}
    assert (dt.date(2021, 12, 31), "New Year's Day (observed)") in h  # 1 Jan 2022 is a Saturday
    assert (dt.date(2021, 6, 18), "Juneteenth National Independence Day (observed)") in h
    assert (dt.date(2022, 11, 24), "Thanksgiving") in h
    assert (dt.date(2022, 5, 30), "Memorial Day") in h
    assert (dt.date(2022, 11, 8), "Election Day") in h
    assert not any(n == "Election Day" and d.year == 2021 for d, n in h)
    early = {r.holiday_name for r in cal.holiday_dim(spark, 2019, 2020).collect()}
    assert "Juneteenth National Independence Day" not in early


def test_zero_and_null_trip_time(spark):
    rows = [(1, dt.datetime(2024, 1, 8, 5), 1, 2.0, 0, 5.0), (2, dt.datetime(2024, 1, 8, 5), 1, 2.0, None, 5.0),
            (3, dt.datetime(2024, 1, 8, 5), 1, 2.0, 360, 5.0)]
    t = rates.with_unit_rates(_trips(spark, rows))
    got = {r.trip_id: r.speed for r in t.collect()}
    assert got[1] is None and got[2] is None and abs(got[3] - 20.0) < 1e-12
    hs = demand.hourly_stats(cal.with_calendar(_trips(spark, rows))).first()
    assert hs.hourly_numTrips == 3 and abs(hs.hourly_mean_speed - 20.0) < 1e-12


def test_null_and_nan_features_are_dropped(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, float("nan"), 2.0), (4, 3.0, 5.0)],
                               "id long, a double, b double")
    assert sorted(r.id for r in feat.complete_features(df, ["a", "b"]).collect()) == [1, 4]
    assert feat.assemble(df, ["a", "b"]).count() == 2
    r = {(x.col_a, x.col_b): x.r for x in feat.correlation_long(df, ["a", "b"]).collect()}
    assert abs(r[("a", "b")] - 1.0) < 1e-12


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "a double, b double")
    r = {(x.col_a, x.col_b): x.r for x in feat.correlation_long(df, ["a", "b"]).collect()}
    assert r[("a", "b")] is None and r[("b", "b")] is None and r[("a", "a")] == 1.0


def test_constant_columns_beside_varying_ones_are_null(spark):
    # one constant column next to a varying pair (no extra pass), and a
    # single varying column next to constants (variance checked)
    df = spark.createDataFrame([(1.0, 2.0, 4.0, 7.0), (2.0, 2.0, 3.0, 7.0), (3.0, 2.0, 5.0, 7.0)],
                               "a double, b double, c double, d double")
    r = {(x.col_a, x.col_b): x.r for x in feat.correlation_long(df, ["a", "b", "c"]).collect()}
    assert r[("b", "b")] is None and r[("a", "b")] is None and r[("a", "a")] == 1.0
    assert abs(r[("a", "c")] - 0.5) < 1e-12
    r = {(x.col_a, x.col_b): x.r for x in feat.correlation_long(df, ["a", "b", "d"]).collect()}
    assert r[("a", "a")] == 1.0 and r[("b", "b")] is None and r[("d", "d")] is None and r[("a", "d")] is None


def test_unknown_zone_and_zone_without_trips(spark):
    zones = spark.createDataFrame([("1", "B1", "Z1"), ("2", "B2", "Z2"), ("x", "B3", "Z3")],
                                  "LocationID string, Borough string, Zone string")
    trips = _trips(spark, [(1, dt.datetime(2024, 1, 8, 5), 1, 1.0, 1, 1.0),
                           (2, dt.datetime(2024, 1, 8, 5), 99, 1.0, 1, 1.0)])
    j = ctx.join_zone(trips, zones, "PU")
    assert [r.trip_id for r in j.collect()] == [1]  # unknown id 99 drops (inner)
    pu = demand.zone_counts(j, "PU")
    heat = ctx.zone_heat_table(zones.select(F.col("Zone").alias("zone")), pu,
                               spark.createDataFrame([], "zone string, do_count long"),
                               spark.createDataFrame([], "zone string, overnight_count long"))
    got = {r.zone: (r.pu_count, r.do_count, r.overnight_count) for r in heat.collect()}
    assert got == {"Z1": (1, 0, 0), "Z2": (0, 0, 0), "Z3": (0, 0, 0)}


def test_drifting_files_conform_and_union(spark, tmpdir_path):
    a = spark.createDataFrame([(1, 1, 2)], "trip_id long, wav_match_flag int, airport_fee int")
    b = spark.createDataFrame([(2, "Y", 2.5)], "trip_id long, wav_match_flag string, airport_fee double")
    pa, pb = f"{tmpdir_path}/m1", f"{tmpdir_path}/m2"
    a.write.parquet(pa)
    b.write.parquet(pb)
    u = rd.read_trips_drifting(spark, [pa, pb])
    assert dict(u.dtypes)["wav_match_flag"] == "string" and dict(u.dtypes)["airport_fee"] == "double"
    assert sorted((r.trip_id, r.wav_match_flag, r.airport_fee) for r in u.collect()) == \
        [(1, "1", 2.0), (2, "Y", 2.5)]
    drift = {(r.column, r.prev_type, r.type) for r in rd.schema_drift(spark, [pa, pb]).collect()}
    assert drift == {("wav_match_flag", "int", "string"), ("airport_fee", "int", "double")}


def test_bad_number_and_date_text(spark):
    raw = spark.createDataFrame([("03/01/2021", "1,234", "5"), ("2021-03-02", "abc", "6"), ("03/03/2021", "7", "8")],
                                ["Date", "Subways: Total Estimated Ridership", "Buses: Total Estimated Ridership"])
    got = [(r.d, r.subways_daily, r.buses_daily) for r in ctx.normalise_transit(raw).orderBy("buses_daily").collect()]
    assert got == [(dt.date(2021, 3, 1), None, 5), (None, None, 6), (dt.date(2021, 3, 3), 7, 8)]


def test_empty_trips_union_identity(spark):
    e = rd.empty_trips(spark)
    assert e.count() == 0 and e.schema == TRIP_SCHEMA


def test_experiment_log_metrics_known_means(spark):
    rows = []
    for model, k in (("lr", 1.0), ("dt", 2.0)):
        for i, pct in enumerate(ex.SIZES):
            for rep in (0, 1):
                rt = k * (i + 1) + rep  # mean k*(i+1) + 0.5
                rows.append((model, 8, pct, rt, rt - 0.5))
    log = spark.createDataFrame(rows, "model string, cores int, pct int, runtime double, runtime_no_overhead double")
    su = {(r.model, r.pct): r for r in ex.size_up(log).collect()}
    assert abs(su[("lr", 10)].runtime - 1.5) < 1e-12 and su[("lr", 10)].size_up == 1.0
    assert abs(su[("dt", 100)].size_up - 10.5 / 2.5) < 1e-12
    assert abs(su[("lr", 40)].overhead - 0.5) < 1e-12 and su[("lr", 80)].ideal == 8.0


def test_correlation_from_moments_equals_that_of_joined_rows(spark, sf):
    from farelane.functions import calendar as c
    from farelane.sources import adapters as ad

    t = c.with_calendar(ad.trips_li(spark, sf)).withColumn("const", F.lit(3.0))
    context = t.groupBy("pickupdate", "pickuphour").agg(F.count("*").alias("n_trips"), F.max("trip_time").alias("longest")).where("n_trips > 1")
    trip, side = ["trip_miles", "trip_time", "base_passenger_fare", "pickupyear", "week", "const"], ["n_trips", "longest"]
    a = {(r.col_a, r.col_b): r.r for r in feat.correlation_with_context(t, context, trip, side).collect()}
    b = {(r.col_a, r.col_b): r.r for r in feat.correlation_long(t.join(context, ["pickupdate", "pickuphour"]), trip + side).collect()}
    assert a.keys() == b.keys() and len(a) == 64
    for k in a:
        if a[k] is None or b[k] is None:
            assert "const" in k
        else:
            assert abs(a[k] - b[k]) < 1e-9, k
    empty = feat.correlation_with_context(t.where("false"), context, trip, side)
    assert {r.r for r in empty.collect()} == {None}


def test_drift_inside_a_folder_is_reported(spark, tmpdir_path):
    path = f"{tmpdir_path}/folder"
    spark.createDataFrame([(1, 1)], "trip_id long, airport_fee int").coalesce(1).write.parquet(f"{path}/a")
    spark.createDataFrame([(2, 2.5)], "trip_id long, airport_fee double").coalesce(1).write.parquet(f"{path}/b")
    got = rd.schema_drift(spark, [f"{path}/*"]).collect()
    assert [(r.file_index, r["column"], r.prev_type, r.type) for r in got] == [(0, "airport_fee", "int", "double")]
    both = rd.read_trips_drifting(spark, [f"{path}/*"], {"airport_fee": "double"})
    assert sorted((r.trip_id, r.airport_fee) for r in both.collect()) == [(1, 1.0), (2, 2.5)]
