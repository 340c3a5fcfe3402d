"""

Every query reads the driver tables through the adapters of FIXTURES.md
(``trips_ev`` from events, ``trips_li`` from lineitem x supplier, ``zones``
from nation x region, ``transit``/``weather`` from orders) and runs over the
whole tables. Integer outputs are BIGINT and floating outputs DOUBLE on both
sides; sums of doubles are rounded the same way on both sides.
"""

from __future__ import annotations

import datetime as _dt
import os as _os
import sys as _sys
from collections.abc import Callable
from importlib.util import find_spec as _find_spec

# Importable from any working directory: the package sits next to this file.
_ROOT = _os.path.dirname(_os.path.abspath(__file__))
if _ROOT not in _sys.path:
    _sys.path.insert(0, _ROOT)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions import calendar as cal
from farelane.functions.labels import company_label
from farelane.operators import context as ctx
from farelane.operators import demand
from farelane.functions import rates
from farelane.operators import features as feat
from farelane.schemas import TRANSIT_DROPPED, TRANSIT_RENAMES, WEATHER_CSV_COLUMNS, YELLOW_COLUMNS
from farelane.plans import experiments as ex
from farelane.plans import forecast as fc
from farelane.plans import global_models as gm
from farelane.plans import local_models as lm
from farelane.schemas import LOG_CSV_SCHEMA
from farelane.session import join_small, scratch_path
from farelane.sources import adapters as ad
from farelane.sources import readers as rd

SMOKE_DIR = "/root/testdata/sf0.001"


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------

def _out(df: DataFrame, digits: int | None = 4, exact=()) -> DataFrame:
    """Canonical output types: integers -> bigint, floats -> double.

    Doubles that come from order-dependent float arithmetic (averages, sums of
    doubles) are rounded on both sides; ``exact`` names columns computed
    exactly (decimal sums, row-level expressions) that are left as they are.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c.cast("double")
            if digits is not None and f.name not in exact:
                c = F.round(c, digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _ev(spark, sf):
    return ad.trips_ev(spark, sf)


def _li(spark, sf):
    return ad.trips_li(spark, sf)


def _ev_cal(spark, sf):
    return cal.with_calendar(_ev(spark, sf))


def _li_cal(spark, sf):
    return cal.with_calendar(_li(spark, sf))


def _ev_flags(spark, sf):
    return cal.with_demand_flags(_ev_cal(spark, sf))


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------

def q_hourly_stats(spark, sf):
    return _out(demand.hourly_stats(_ev_cal(spark, sf), exact=True),
                exact=("hourly_total_miles", "hourly_total_base_fare"))


def q_daily_stats(spark, sf):
    return _out(demand.daily_stats(_li_cal(spark, sf), exact=True),
                exact=("daily_total_miles", "daily_total_base_fare"))


def q_daily_count(spark, sf):
    return _out(demand.daily_count(_li_cal(spark, sf)))


def q_calendar_columns(spark, sf):
    c = _ev_cal(spark, sf)
    return _out(c.select("trip_id", "pickupdate", "pickupyear", "pickupmonth", "pickupdayofyear",
                         "pickuphour", "pickupdayofweek", "week"))


def q_demand_flags(spark, sf):
    f = _ev_flags(spark, sf)
    return _out(f.select("trip_id", "pickupdate", "pickuphour", "isWeekend", "isOvernight", "isRushhour"))


def q_week_index_linear(spark, sf):
    t = _li(spark, sf)
    return _out(t.groupBy(F.year("pickup_datetime").alias("pickupyear"),
                          F.weekofyear("pickup_datetime").alias("iso_week"),
                          cal.week_index_linear("pickup_datetime").alias("week"))
                .agg(F.count("*").alias("trip_count")))


def q_week_index_case(spark, sf):
    t = _li(spark, sf)
    return _out(t.groupBy(F.year("pickup_datetime").alias("pickupyear"),
                          F.weekofyear("pickup_datetime").alias("iso_week"),
                          cal.week_index_case("pickup_datetime").alias("week_case"),
                          cal.week_start("pickup_datetime").alias("week_start"))
                .agg(F.count("*").alias("trip_count")))


def q_holiday_dim(spark, sf):
    t = _li(spark, sf).select(F.to_date("pickup_datetime").alias("d"))
    return _out(cal.holiday_dim_for(t, "d"))


def q_holiday_trips(spark, sf):
    f = _ev_cal(spark, sf)
    hd = cal.holiday_dates(cal.holiday_dim_for(f, "pickupdate"))
    j = join_small(f, hd, f.pickupdate == hd.holiday_date, "left_semi")
    return _out(j.groupBy("pickupdate").agg(F.count("*").alias("trip_count")))


def _company(unit, li=False):
    def q(spark, sf):
        c = _li_cal(spark, sf) if li else _ev_cal(spark, sf)
        return _out(demand.company_counts(c, unit))
    return q


def q_month_by_weekday(spark, sf):
    return _out(demand.month_weekday_counts(_li_cal(spark, sf)))


def q_pivot_company_month(spark, sf):
    return _out(demand.pivot_company_month(_ev_cal(spark, sf)))


def q_pivot_month_weekday(spark, sf):
    return _out(demand.pivot_month_weekday(_li_cal(spark, sf)))


def q_weekly_series(spark, sf):
    return _out(demand.weekly_series(_li_cal(spark, sf)))


def _li_zoned(spark, sf, role):
    return ctx.join_zone(_li(spark, sf), ad.zones(spark, sf), role)


def q_pickup_zone_counts(spark, sf):
    return _out(demand.zone_counts(_li_zoned(spark, sf, "PU"), "PU"))


def q_dropoff_zone_counts(spark, sf):
    return _out(demand.zone_counts(_li_zoned(spark, sf, "DO"), "DO"))


def _ev_flags_zoned(spark, sf):
    return ctx.join_zone(_ev_flags(spark, sf), ad.zones(spark, sf), "PU")


def q_zone_flag_counts(spark, sf):
    return _out(demand.zone_flag_counts(_ev_flags_zoned(spark, sf)))


def q_zone_pair_counts(spark, sf):
    z = ad.zones(spark, sf)
    t = ctx.join_zone(ctx.join_zone(_ev(spark, sf), z, "PU"), z, "DO")
    return _out(t.groupBy("PUZone", "DOZone").agg(F.count("*").alias("trip_count")))


def q_join_zone(spark, sf):
    t = ctx.join_zone(_ev(spark, sf), ad.zones(spark, sf), "PU")
    return _out(t.select("trip_id", "PULocationID", "PUBorough", "PUZone"))


def q_zone_heat_table(spark, sf):
    z = ad.zones(spark, sf)
    names = z.select(F.col("Zone").alias("zone"))
    # One pass: pickup, dropoff and (weekday-only) flag counts per zone.
    act = ctx.zone_activity(_ev_flags(spark, sf), z, F.dayofweek("pickupdate").isin(2, 3, 4, 5, 6))
    return _out(ctx.zone_heat_table(names, act))


def q_zone_heat_files(spark, sf):
    """The heat table as users have it: a geometry file and three count files, joined by zone name."""
    z = ad.zones(spark, sf)
    act = ctx.zone_activity(_ev_flags(spark, sf), z, F.dayofweek("pickupdate").isin(2, 3, 4, 5, 6))
    geom = z.select(F.col("Zone").alias("zone"), F.concat(F.lit("POINT ("), "LocationID", F.lit(" 1)")).alias("the_geom"))
    tables = {"geometry": geom, "pu": act.select("zone", "pu_count"), "do": act.select("zone", "do_count"),
              "flags": act.select("zone", "overnight_count", "rushhour_count", "weekend_count")}
    paths = [rd.write_table(df, scratch_path(spark, f"zone_{name}"), "csv") for name, df in tables.items()]
    return _out(ctx.zone_heat_table(*rd.read_zone_tables(spark, *paths)))


def q_top_zones(spark, sf):
    pu = demand.zone_counts(_li_zoned(spark, sf, "PU"), "PU")
    return _out(demand.top_n(pu, [F.desc("pu_count"), F.asc("zone")], 5))


def q_scan_trip_count(spark, sf):
    return _out(_li(spark, sf).agg(F.count("*").alias("n_trips")))


def q_project_trip_core(spark, sf):
    return _out(_ev(spark, sf).select("trip_id", "pickup_datetime", "trip_miles", "trip_time",
                                      "base_passenger_fare", "PULocationID"), None)


def q_drop_columns(spark, sf):
    return _out(_ev(spark, sf).drop("pickup_datetime", "DOLocationID", "hvfhs_license_num"), None)


def q_filter_year(spark, sf):
    # A range on the timestamp (not year() = 1998) so Parquet min/max statistics prune.
    lo = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    t = _li(spark, sf).where((F.col("pickup_datetime") >= lo) & (F.col("pickup_datetime") < hi))
    return _out(t.select("trip_id", "pickup_datetime", "base_passenger_fare"), None)


def q_filter_company(spark, sf):
    return _out(demand.company_counts(_ev_cal(spark, sf), "pickuphour")
                .where("hvfhs_license_num = 'HV0003'"))


def q_dropna_any(spark, sf):
    return _out(_ev(spark, sf).dropna("any"), None)


def q_company_labels(spark, sf):
    c = demand.company_counts(_ev_cal(spark, sf), "pickupyear")
    return _out(c.withColumn("company", company_label("hvfhs_license_num")))


# --- rates, context joins, CSV round trips, correlation -------------------

def q_unit_rates(spark, sf):
    t = rates.with_unit_rates(_ev(spark, sf))
    return _out(t.select("trip_id", "speed", "trip_meters", "trip_km"), None)


def _ev_context(spark, sf):
    c = _ev_cal(spark, sf)
    h = demand.hourly_stats(c, exact=True)
    d = demand.daily_stats(c, exact=True)
    return h.join(d, ["pickupdate", "pickupyear", "pickupmonth"])


def q_fare_rates(spark, sf):
    r = rates.with_fare_rates(_ev_context(spark, sf))
    return _out(r.select("pickupdate", "pickuphour", "d_base_fare_per_mile", "d_base_fare_per_min",
                         "h_base_fare_per_mile", "h_base_fare_per_min"), None)


def q_temp_extremity(spark, sf):
    w = ad.weather(spark, sf)
    return _out(w.select("d", rates.temp_extremity("tmax_f").alias("TMAXExtremity"),
                         rates.temp_extremity("tmin_f").alias("TMINExtremity")), None)


def q_transit_taxi_ratio(spark, sf):
    dc = demand.daily_count(_li_cal(spark, sf))
    j = ctx.join_transit(dc, ad.transit(spark, sf))
    return _out(j.select("pickupdate", "daily_numTrips",
                         rates.transit_taxi_ratio(ad.TRANSIT_MODES).alias("pt_taxi_ratio")), None)


def _yellow_raw(spark, sf):
    """Yellow-taxi shaped columns from events: dropoff = pickup + trip_time seconds."""
    e = _ev(spark, sf)
    return e.select("trip_id",
                    F.col("pickup_datetime").alias("tpep_pickup_datetime"),
                    (F.col("pickup_datetime") + F.make_interval(secs=F.col("trip_time").cast("int")))
                    .alias("tpep_dropoff_datetime"),
                    F.col("trip_miles").alias("trip_distance"),
                    F.col("base_passenger_fare").alias("fare_amount"))


def q_trip_duration(spark, sf):
    y = _yellow_raw(spark, sf)
    return _out(y.select("trip_id", rates.trip_duration("tpep_dropoff_datetime", "tpep_pickup_datetime")
                         .alias("duration_s")), None)


def q_yellow_adapter(spark, sf):
    y = feat.adapt(_yellow_raw(spark, sf), [("trip_id", "trip_id", "bigint")] + YELLOW_COLUMNS)
    return _out(feat.yellow_features(y, keep=("trip_id",)), None)


def q_parse_dates(spark, sf):
    o = ad.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    bad = F.col("o_orderkey") % 97 == 0
    raw = o.select("o_orderkey",
                   F.when(bad, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "dd-MM-yyyy")).alias("a"),
                   F.date_format("o_orderdate", "MM/dd/yyyy").alias("b"))
    return _out(raw.select("o_orderkey", cal.parse_date("a", "dd-MM-yyyy").alias("d_dmy"),
                           cal.parse_date("b", "MM/dd/yyyy").alias("d_mdy")))


def _write_read_csv(spark, df, name):
    path = scratch_path(spark, name)
    rd.write_table(df, path, "csv")
    return rd.read_csv_strings(spark, path)


def q_weather_normalise(spark, sf):
    w = ad.weather(spark, sf)
    inch = 25.4
    raw = w.select(F.date_format("d", "dd-MM-yyyy").alias(WEATHER_CSV_COLUMNS[0]),
                   F.col("tmax_f").cast("string").alias(WEATHER_CSV_COLUMNS[1]),
                   F.col("tmin_f").cast("string").alias(WEATHER_CSV_COLUMNS[2]),
                   F.col("prcp_mm").cast("string").alias(WEATHER_CSV_COLUMNS[3]),
                   F.lit("0").alias(WEATHER_CSV_COLUMNS[4]),
                   F.lit("abc").alias(WEATHER_CSV_COLUMNS[5]),
                   (F.col("prcp_mm") / inch).cast("string").alias(WEATHER_CSV_COLUMNS[6]),
                   F.lit("0").alias(WEATHER_CSV_COLUMNS[7]),
                   F.lit("0").alias(WEATHER_CSV_COLUMNS[8]))
    back = _write_read_csv(spark, raw, "weather_csv")
    return _out(ctx.normalise_weather(back), None)


def q_transit_normalise(spark, sf):
    t = ad.transit(spark, sf)
    long = {v.lower(): k for k, v in TRANSIT_RENAMES.items()}
    cols = [F.date_format("d", "MM/dd/yyyy").alias("Date")]
    cols += [F.format_number(F.col(m), 0).alias(long[m]) if m == "subways_daily"
             else F.col(m).cast("string").alias(long[m]) for m in ad.TRANSIT_MODES]
    cols += [F.lit("50%").alias(c) for c in TRANSIT_DROPPED]
    back = _write_read_csv(spark, t.select(*cols), "transit_csv")
    return _out(ctx.normalise_transit(back))


def q_csv_roundtrip_dim(spark, sf):
    back = _write_read_csv(spark, ad.zones(spark, sf), "zones_csv")
    return _out(ctx.zone_dim(back, "PU"))


def q_join_weather(spark, sf):
    j = ctx.join_weather(_li_cal(spark, sf), ad.weather(spark, sf))
    return _out(j.select("trip_id", "pickupdate", "tmax_f", "tmin_f", "prcp_mm", "TMAXExtremity",
                         "TMINExtremity"), None)


def q_join_transit(spark, sf):
    j = ctx.join_transit(_li_cal(spark, sf), ad.transit(spark, sf))
    return _out(j.select("trip_id", "pickupdate", *ad.TRANSIT_MODES))


def q_attach_hourly(spark, sf):
    j = ctx.attach_hourly(_ev_cal(spark, sf), exact=True)
    return _out(j.select("trip_id", "pickuphour", "hourly_numTrips", "hourly_total_time",
                         "hourly_total_base_fare", "hourly_mean_speed"),
                exact=("hourly_total_base_fare",))


def q_attach_daily(spark, sf):
    j = ctx.attach_daily(_li_cal(spark, sf), exact=True)
    return _out(j.select("trip_id", "pickupdate", "daily_numTrips", "daily_total_miles",
                         "daily_total_base_fare", "daily_mean_speed"),
                exact=("daily_total_miles", "daily_total_base_fare"))


def q_daily_count_join(spark, sf):
    j = ctx.with_daily_count(_li_cal(spark, sf))
    return _out(j.select("trip_id", "pickupdate", "daily_numTrips"))


def _li_context(spark, sf, trips_cal):
    """The (date, hour) context of the trips; both daily dimensions come from one pass over orders."""
    daily = ad.daily_dimensions(spark, sf)
    return ctx.context_table(trips_cal, ad.weather(spark, sf, daily), ad.transit(spark, sf, daily), ad.TRANSIT_MODES, exact=True)


CONTEXT_COLS = ["pickupdate", "pickuphour", "hourly_numTrips", "daily_numTrips", "isWeekend", "isOvernight",
                "isRushhour", "d_base_fare_per_mile", "d_base_fare_per_min", "h_base_fare_per_mile",
                "h_base_fare_per_min", "hourly_mean_speed", "tmax_f", "tmin_f", "prcp_mm", "TMAXExtremity",
                "TMINExtremity", *ad.TRANSIT_MODES, "pt_taxi_ratio"]
CONTEXT_EXACT = tuple(c for c in CONTEXT_COLS if c != "hourly_mean_speed")


def q_context_features(spark, sf):
    c = _li_cal(spark, sf)
    t = _li_context(spark, sf, c)
    return _out(t.select(*CONTEXT_COLS), exact=CONTEXT_EXACT)


def q_attach_context(spark, sf):
    c = _li_cal(spark, sf)
    t = _li_context(spark, sf, c)
    j = ctx.attach_context(c, t.select("pickupdate", "pickuphour", "pt_taxi_ratio", "TMAXExtremity",
                                       "isWeekend", "isRushhour", "daily_numTrips"))
    return _out(j.select("trip_id", "pickupdate", "pt_taxi_ratio", "TMAXExtremity", "isWeekend",
                         "isRushhour", "daily_numTrips"), None)


CORR_COLS = ["trip_miles", "trip_time", "base_passenger_fare", "daily_numTrips", "tmax_f", "tmin_f",
             "prcp_mm", "TMINExtremity", "pt_taxi_ratio", "isWeekend"]


WIDE_CTX = ["hourly_numTrips", "daily_numTrips", "isWeekend", "isOvernight", "isRushhour",
            "d_base_fare_per_mile", "d_base_fare_per_min", "h_base_fare_per_mile", "h_base_fare_per_min",
            "tmax_f", "tmin_f", "prcp_mm", "TMAXExtremity", "TMINExtremity", *ad.TRANSIT_MODES, "pt_taxi_ratio"]
WIDE_TRIP = ["trip_miles", "trip_time", "base_passenger_fare", "PULocationID", "DOLocationID", "pickupyear",
             "pickupmonth", "pickupdayofyear", "pickuphour", "week"]


# The first four stages correlate the context table itself, the last one trips with their context.
CORR_STAGES = {
    "correlation_weather": ["pickuphour", *WIDE_CTX[:12]],
    "correlation_extremity": ["pickuphour", *WIDE_CTX[:14]],
    "correlation_transit": ["pickuphour", *WIDE_CTX[:-1]],
    "correlation_ratio": ["pickuphour", *WIDE_CTX],
}


def _correlation_stage(cols):
    def q(spark, sf):
        return _out(feat.correlation_long(_li_context(spark, sf, _li_cal(spark, sf)), cols), 6)
    return q


def q_correlation_matrix_wide(spark, sf):
    """All numeric columns of trips with their (date, hour) context (the last, widest stage)."""
    c = _li_cal(spark, sf)
    return _out(feat.correlation_with_context(c, _li_context(spark, sf, c), WIDE_TRIP, WIDE_CTX), 6)


def q_correlation_matrix(spark, sf):
    c = _li_cal(spark, sf)
    return _out(feat.correlation_with_context(c, _li_context(spark, sf, c), CORR_COLS[:3], CORR_COLS[3:]), 6)


# --- sources: conformance, drifting union, drift audit, logs, export -------

def _drifting_part(ev, typed: bool):
    """Trips with the columns whose types drift between monthly files."""
    if typed:  # older files: ints everywhere
        return ev.select("trip_id", F.col("PULocationID").cast("int").alias("PULocationID"),
                         (F.col("trip_id") % 4).cast("int").alias("airport_fee"),
                         F.when(F.col("trip_id") % 3 == 0, 1).otherwise(0).alias("wav_match_flag"))
    return ev.select("trip_id", F.col("PULocationID").cast("string").alias("PULocationID"),
                     F.col("base_passenger_fare").alias("airport_fee"),
                     F.when(F.col("trip_id") % 3 == 0, "Y").otherwise("N").alias("wav_match_flag"))


def q_conform_types(spark, sf):
    e = _ev(spark, sf)
    raw = e.select("trip_id",
                   F.when(F.col("trip_id") % 50 == 0, F.lit("abc"))
                   .otherwise(F.col("PULocationID").cast("string")).alias("PULocationID"),
                   F.col("DOLocationID").cast("int").alias("DOLocationID"),
                   (F.col("trip_id") % 3).cast("int").alias("airport_fee"),
                   (F.col("trip_id") % 2).cast("int").alias("wav_match_flag"))
    return _out(rd.conform(raw), None)


def _write_drifting(spark, sf, n_new=1):
    e = _ev(spark, sf)
    paths = [scratch_path(spark, "month_old")]
    _drifting_part(e.where(F.col("trip_id") % 2 == 0), True).write.parquet(paths[0])
    for i in range(n_new):
        p = scratch_path(spark, f"month_new{i}")
        _drifting_part(e.where(F.col("trip_id") % 2 == 1), False).write.parquet(p)
        paths.append(p)
    return paths


def q_scan_conformed_union(spark, sf):
    paths = _write_drifting(spark, sf)
    u = rd.read_trips_drifting(spark, paths, columns=["trip_id", "PULocationID", "airport_fee", "wav_match_flag"])
    return _out(u.groupBy("wav_match_flag").agg(
        F.count("*").alias("n"), rates.measure_sum("airport_fee", True).alias("airport_fee_sum"),
        F.sum("PULocationID").alias("pu_sum")), None)


def q_schema_drift(spark, sf):
    paths = _write_drifting(spark, sf, n_new=2)
    return _out(rd.schema_drift(spark, paths).drop("file"))


def q_empty_union_identity(spark, sf):
    e = rd.conform(_ev(spark, sf))
    u = rd.empty_trips(spark).unionByName(e.drop("trip_id"), allowMissingColumns=True)
    return _out(u.groupBy("hvfhs_license_num").agg(
        F.count("*").alias("n"), F.count_if(F.col("dispatching_base_num").isNull()).alias("n_null_base")))


def q_log_append_roundtrip(spark, sf):
    log = ad.experiment_log(spark, sf)
    parts = []
    for model in ("lr", "dt"):
        path = scratch_path(spark, f"log_{model}")
        m = log.where(F.col("model") == model).drop("model")
        rd.append_log(m.where(F.col("pct") <= 20), path)
        rd.append_log(m.where(F.col("pct") > 20), path)
        parts.append(rd.read_experiment_log(spark, path, model))
    back = parts[0].unionByName(parts[1])
    return _out(back.groupBy("model", "cores", "pct").agg(
        F.count("*").alias("n"), rates.measure_sum("runtime", True).alias("runtime_sum")), None)


def q_export_roundtrip(spark, sf):
    heat = q_zone_heat_table(spark, sf)
    path = scratch_path(spark, "heat_csv")
    rd.write_table(heat, path, "csv")
    schema = "zone string, pu_count bigint, do_count bigint, overnight_count bigint, rushhour_count bigint, " \
             "weekend_count bigint"
    return _out(rd.read_csv_typed(spark, path, T.StructType.fromDDL(schema)))


# --- feature tables, split, sample, buckets -------------------------------

def q_complete_features(spark, sf):
    t = rates.with_unit_rates(_ev(spark, sf))
    return _out(feat.complete_features(t, ["speed", "trip_meters"]).select("trip_id", "speed", "trip_meters"), None)


def _ev_fare(spark, sf, calendar="day"):
    return feat.fare_features(_ev(spark, sf), calendar)


def q_fare_features(spark, sf):
    return _out(_ev_fare(spark, sf), None)


def q_assembled_rows(spark, sf):
    from pyspark.ml.functions import vector_to_array
    a = feat.assemble(_ev_fare(spark, sf), feat.GLOBAL_FEATURES)
    arr = vector_to_array("features")
    return _out(a.select("trip_id", *[arr[i].alias(f"f{i}") for i in range(len(feat.GLOBAL_FEATURES))]), None)


def q_train_test_split(spark, sf):
    sides = feat.with_side(_li(spark, sf)).groupBy("side")
    return _out(sides.agg(F.count("*").alias("n_rows"), rates.measure_sum("base_passenger_fare", True).alias("fare_sum")), None)


def q_sample_by_key(spark, sf):
    return _out(feat.sample_sizes(_li(spark, sf), [p / 100 for p in ex.SIZES]))


def q_bucket_sizes(spark, sf):
    tr, _ = feat.train_test_split(_li(spark, sf))
    return _out(feat.bucket_sizes(tr, 16))


# --- models -----------------------------------------------------------------

LR2 = ["trip_meters", "trip_time"]


def _ev_split(spark, sf, calendar="day"):
    return feat.train_test_split(_ev_fare(spark, sf, calendar))


def q_ols_single(spark, sf):
    tr, _ = _ev_split(spark, sf)
    o = gm.ols_single(tr, "trip_meters")
    return _out(o.select(F.round("slope", 10).alias("slope"), F.round("intercept", 8).alias("intercept"), "n"),
                None)


def q_rmse(spark, sf):
    tr, te = _ev_split(spark, sf)
    o = gm.ols_single(tr, "trip_meters").first()
    p = te.withColumn("prediction", gm.predict_linear({"trip_meters": o["slope"]}, o["intercept"]))
    return _out(gm.rmse(p), 6)


def q_local_lr_models(spark, sf):
    tr, _ = _ev_split(spark, sf)
    return _out(lm.fit_local_lr(tr, LR2, feat.LABEL, 16), 6)


def q_local_lr_predictions(spark, sf):
    tr, te = _ev_split(spark, sf)
    models = lm.fit_local_lr(tr, LR2, feat.LABEL, 16)
    return _out(gm.rmse(lm.score_lr_ensemble(models, te)), 6)


def q_global_lr_rmse(spark, sf):
    r = gm.global_rmse(_ev_fare(spark, sf), feat.GLOBAL_FEATURES, "lr")
    return _out(r, 6)


def q_global_dt_rmse(spark, sf):
    return _out(gm.global_rmse(_ev_fare(spark, sf), feat.GLOBAL_FEATURES, "dt"), 6)


def q_global_gbt_rmse(spark, sf):
    """Twenty trees are fitted and scored; SQL follows the first two, so their errors stand here."""
    r = gm.global_rmse(_ev_fare(spark, sf), feat.GLOBAL_FEATURES, "gbt", stages=(1, 2))
    return _out(r.select("model", "n_train", "n_test", "mean_rmse", "rmse_1", "rmse_2", "beats_mean"), 6)


def q_global_tree_nodes(spark, sf):
    """The global tree's nodes: rows, mean, split and error drop of each."""
    n = gm.global_nodes(_ev_fare(spark, sf), feat.GLOBAL_FEATURES, "dt").frame(spark)
    return _out(n.select("node", "level", "n", F.round("value", 6).alias("value"), "feature_name", F.round("threshold", 6).alias("threshold"),
                         F.round("gain", 2).alias("gain")), None)


def q_global_gbt_stages(spark, sf):
    """Nodes of the first two boosted trees: the second is grown on what the first leaves over."""
    n = gm.global_nodes(_ev_fare(spark, sf), feat.GLOBAL_FEATURES, "gbt").frame(spark).where("tree < 2")
    return _out(n.select(F.col("tree").alias("stage"), "weight", "node", "n", F.round(F.col("s") + 1e-9, 4).alias("residual_sum"), "feature_name",
                         F.round("threshold", 6).alias("threshold")), None)


def q_global_lr_pair(spark, sf):
    """The global linear pipeline on two features, whose normal equations SQL can state."""
    tr, te = _ev_split(spark, sf)
    return _out(gm.rmse(gm.score(gm.fit_global(tr, LR2, "lr"), te)), 6)


def _with_gaps(trips):
    """Trips of which some lack the label or a feature."""
    return trips.withColumns({
        "base_passenger_fare": F.when(F.col("trip_id") % 7 != 0, F.col("base_passenger_fare")),
        "trip_time": F.when(F.col("trip_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("trip_time").cast("double"))})


def q_local_lr_gaps(spark, sf):
    tr, _ = _ev_split(spark, sf)
    return _out(lm.fit_local_lr(_with_gaps(tr), LR2, feat.LABEL, 16), 6)


def _tree_nodes(models, spark):
    # means of few values often end in a 5: a small shift keeps the last bit of a sum from deciding the rounding
    n = models.nodes(spark).select("bucket", "node", "level", "n", F.round(F.col("value") + 1e-9, 6).alias("value"), "feature_name",
                                   F.round("threshold", 6).alias("threshold"), F.round(F.col("gain") + 1e-6, 4).alias("gain"))
    return _out(n, None)


def q_local_tree_models(spark, sf):
    tr, _ = _ev_split(spark, sf, "hour")
    return _tree_nodes(lm.fit_local_trees(tr, feat.LOCAL_FEATURES, feat.LABEL, 16, 5), spark)


def q_local_tree_gaps(spark, sf):
    tr, _ = _ev_split(spark, sf, "hour")
    return _tree_nodes(lm.fit_local_trees(_with_gaps(tr), feat.LOCAL_FEATURES, feat.LABEL, 4, 3), spark)


def q_local_tree_predictions(spark, sf):
    tr, te = _ev_split(spark, sf, "hour")
    m = lm.fit_local_trees(tr, feat.LOCAL_FEATURES, feat.LABEL, 16, 5)
    return _out(gm.rmse(lm.score_tree_ensemble(m, te)), 6)


def q_tree_root_split(spark, sf):
    """The first split of a single tree over all training rows."""
    tr, _ = _ev_split(spark, sf, "hour")
    m = lm.fit_trees(tr.withColumn("bucket", F.lit(0)), ["trip_time", "trip_meters", "hour"], feat.LABEL, 1, 32)
    return _out(m.nodes(spark).where("level = 0").select("feature_name", "threshold", "n", "gain"), 4)


def _yellow_ev(spark, sf):
    y = feat.adapt(_yellow_raw(spark, sf), [("trip_id", "trip_id", "bigint")] + YELLOW_COLUMNS)
    return feat.yellow_features(y, keep=("trip_id",))


FARE_PARTS = [e.rpartition(" AS ")[2] for e in ad.FARE_PARTS_EXPRS]
SNOW_TRAFFIC = [e.rpartition(" AS ")[2] for e in ad.SNOW_TRAFFIC_EXPRS]
VOTE_FEATURES = ["pickupyear", "pickupmonth", "pickupdayofyear", "pickuphour", "PULocationID", "DOLocationID", "trip_time",
                 *FARE_PARTS, "trip_meters", "week", "hourly_numTrips", "daily_numTrips", "isWeekend",
                 "isOvernight", "isRushhour", "d_base_fare_per_mile", "d_base_fare_per_min", "h_base_fare_per_mile",
                 "h_base_fare_per_min", "hourly_mean_speed", "tmax_f", "tmin_f", "prcp_mm", "TMAXExtremity", "TMINExtremity",
                 *ad.TRANSIT_MODES, *SNOW_TRAFFIC, "pt_taxi_ratio"]
# the label stands in the list of votes too; it is no feature, so it has none
VOTE_DOMAIN = [*VOTE_FEATURES, feat.LABEL]


def _vote_rows(spark, sf):
    """Trips with their fare parts, and the context of a date and hour: calendar, demand, weather, transit, snow and traffic."""
    c = cal.with_calendar(ad.trips_li(spark, sf, fare_parts=True)).withColumn("trip_meters", rates.trip_meters())
    t = join_small(_li_context(spark, sf, c), ad.snow_and_traffic(spark, sf), "pickupdate").withColumn("week", cal.week_index_linear("pickupdate"))
    own = ["PULocationID", "DOLocationID", "trip_time", *FARE_PARTS, "trip_meters"]
    return c, t.select("pickupdate", *[x for x in VOTE_FEATURES if x not in own])


VOTE_KEYS = ("pickupdate", "pickuphour")


def _selected(spark, sf, **sizes):
    trips, context = _vote_rows(spark, sf)
    return lm.select_features(trips, VOTE_FEATURES, feat.LABEL, context=context, keys=VOTE_KEYS, **sizes)


def q_feature_votes(spark, sf):
    return _out(lm.feature_votes(_selected(spark, sf, n_buckets=24, n_trees=100, depth=5), VOTE_DOMAIN))


# a forest small enough for SQL to grow it too
SMALL_FOREST = {"n_buckets": 3, "n_trees": 3, "depth": 3}


def q_feature_votes_small(spark, sf):
    return _out(lm.feature_votes(_selected(spark, sf, **SMALL_FOREST), VOTE_DOMAIN))


def q_forest_importances(spark, sf):
    tr, _ = _ev_split(spark, sf, "hour")
    f = lm.forest_importances(tr, feat.LOCAL_FEATURES, feat.LABEL, n_buckets=2, n_trees=6, depth=4)
    return _out(f.select("bucket", "feature", F.round("importance", 6).alias("importance"), "selected"), None)


# --- weekly series and forecasts -------------------------------------------

def _li_lags(spark, sf):
    return fc.weekly_lags(fc.weekly_counts(_li(spark, sf), "PULocationID"))


def q_weekly_lags(spark, sf):
    return _out(_li_lags(spark, sf))


def _forecast(model):
    def q(spark, sf):
        f = fc.forecast(_li_lags(spark, sf)).where(F.col("model") == model)
        return _out(f, 4)
    return q


def q_forecast_arma(spark, sf):
    """All orders of a seasonal ARMA, and which has the lowest AIC."""
    return _out(fc.forecast_arma(_li_lags(spark, sf)), 4)


# --- experiment metrics -----------------------------------------------------

def q_metrics_mean_runtime(spark, sf):
    return _out(ex.mean_runtimes(ad.experiment_log(spark, sf), ["pct"]), 6)


def q_metrics_size_up(spark, sf):
    return _out(ex.size_up(ad.experiment_log(spark, sf)), 6)


def q_metrics_speed_up(spark, sf):
    return _out(ex.speed_up(ad.experiment_log(spark, sf)), 6)


def q_metrics_scale_up(spark, sf):
    return _out(ex.scale_up(ad.experiment_log(spark, sf)), 6)


def q_metrics_compare(spark, sf):
    return _out(ex.compare_models(ad.experiment_log(spark, sf)), 6)


# ---------------------------------------------------------------------------
# DuckDB oracle SQL
# ---------------------------------------------------------------------------

TRIPS_EV = "trips_ev AS (SELECT " + ", ".join(ad.TRIPS_EV_EXPRS) + " FROM events)"
TRIPS_LI = ("trips_li AS (SELECT " + ", ".join(ad.TRIPS_LI_EXPRS)
            + " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)")
ZONES = ("zones AS (SELECT CAST(n_nationkey AS VARCHAR) AS LocationID, r_name AS Borough, n_name AS Zone "
         "FROM nation JOIN region ON n_regionkey = r_regionkey)")
TRANSIT = ("transit AS (SELECT CAST(o_orderdate AS DATE) AS d, "
           + ", ".join(f"CAST(SUM(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS BIGINT) AS {m}"
                       for m, p in ad.TRANSIT_AGGS)
           + " FROM orders GROUP BY CAST(o_orderdate AS DATE))")
WEATHER = ("weather AS (SELECT CAST(o_orderdate AS DATE) AS d, "
           "CAST(20 + SUM(o_custkey) % 80 AS DOUBLE) AS tmax_f, CAST(SUM(o_custkey) % 60 AS DOUBLE) AS tmin_f, "
           "CAST(COUNT(*) AS DOUBLE) AS prcp_mm FROM orders GROUP BY CAST(o_orderdate AS DATE))")


def _cal_sql(src: str, name: str) -> str:
    ts = "pickup_datetime"
    return (f"{name} AS (SELECT *, CAST({ts} AS DATE) AS pickupdate, year({ts}) AS pickupyear, "
            f"month({ts}) AS pickupmonth, dayofyear({ts}) AS pickupdayofyear, hour({ts}) AS pickuphour, "
            f"dayofweek({ts}) + 1 AS pickupdayofweek, weekofyear({ts}) + (year({ts}) - 2019) * 52 - 4 AS week "
            f"FROM {src})")


def _py_holidays(y0: int, y1: int, extras: bool = True) -> list[tuple[_dt.date, str, bool]]:
    """Independent plain-Python statement of the holiday rules (oracle side)."""
    D = _dt.date
    one = _dt.timedelta(days=1)

    def nth(y, m, wd, n):
        d = D(y, m, 1)
        return d + ((wd - d.weekday()) % 7) * one + 7 * (n - 1) * one

    def last(y, m, wd):
        d = (D(y + 1, 1, 1) if m == 12 else D(y, m + 1, 1)) - one
        return d - ((d.weekday() - wd) % 7) * one

    out = []
    for y in range(y0, y1):
        fixed = [("New Year's Day", D(y, 1, 1)), ("Independence Day", D(y, 7, 4)),
                 ("Veterans Day", D(y, 11, 11)), ("Christmas Day", D(y, 12, 25))]
        if y >= 2021:
            fixed.append(("Juneteenth National Independence Day", D(y, 6, 19)))
        floating = [("Martin Luther King Jr. Day", nth(y, 1, 0, 3)), ("Washington's Birthday", nth(y, 2, 0, 3)),
                    ("Memorial Day", last(y, 5, 0)), ("Labor Day", nth(y, 9, 0, 1)),
                    ("Columbus Day", nth(y, 10, 0, 2)), ("Thanksgiving", nth(y, 11, 3, 4))]
        if extras:
            fixed += [("Lincoln's Birthday", D(y, 2, 12)), ("Susan B. Anthony Day", D(y, 2, 15))]
            if y % 2 == 0:
                floating.append(("Election Day", nth(y, 11, 0, 1) + one))
        for n, d in fixed + floating:
            out.append((d, n, False))
        for n, d in fixed:
            if d.weekday() == 5:
                out.append((d - one, n + " (observed)", True))
            elif d.weekday() == 6:
                out.append((d + one, n + " (observed)", True))
    return out


def _date_list(y0=1980, y1=2040) -> str:
    """Holidays of far more years than the driver tables hold."""
    ds = sorted({d for d, _, _ in _py_holidays(y0, y1)})
    return ", ".join(f"DATE '{d.isoformat()}'" for d in ds)


def _flags_sql(date: str = "pickupdate", hour: str = "pickuphour") -> str:
    wk = f"({date} IN ({_date_list()}) OR dayofweek({date}) IN (0, 6))"
    return (f"CAST(CASE WHEN {wk} THEN 1 ELSE 0 END AS BIGINT) AS isWeekend, "
            f"CAST(CASE WHEN {hour} IN (20, 21, 22, 23, 0, 1, 2, 3, 4, 5) THEN 1 ELSE 0 END AS BIGINT) AS isOvernight, "
            f"CAST(CASE WHEN {hour} IN (16, 17, 18, 19) OR NOT {wk} THEN 1 ELSE 0 END AS BIGINT) AS isRushhour")


EV_CAL = f"WITH {TRIPS_EV}, {_cal_sql('trips_ev', 'c')}"
LI_CAL = f"WITH {TRIPS_LI}, {_cal_sql('trips_li', 'c')}"
EV_FLAGS = f"{EV_CAL}, f AS (SELECT *, {_flags_sql()} FROM c)"


def _xsum(c: str) -> str:
    """Exact decimal sum, the twin of ``measure_sum(..., exact=True)``."""
    return f"CAST(sum(CAST({c} AS DECIMAL(38, 6))) AS DOUBLE)"


def _grain_sql(keys: str, prefix: str) -> str:
    return (f"SELECT {keys}, count(*) AS {prefix}_numTrips, {_xsum('trip_miles')} AS {prefix}_total_miles, "
            f"CAST(sum(trip_time) AS BIGINT) AS {prefix}_total_time, "
            f"{_xsum('base_passenger_fare')} AS {prefix}_total_base_fare, "
            f"round(avg(trip_miles / nullif(trip_time, 0) * 3600), 4) AS {prefix}_mean_speed "
            f"FROM c GROUP BY {keys}")


def _holiday_values_sql(y0, y1) -> str:
    rows = ", ".join(f"(DATE '{d.isoformat()}', '{n.replace(chr(39), chr(39) * 2)}', {str(o).upper()})"
                     for d, n, o in _py_holidays(y0, y1))
    return f"SELECT * FROM (VALUES {rows}) AS h(holiday_date, holiday_name, is_observed)"


def _li_years() -> tuple[int, int]:
    # lineitem ship dates of the driver tables span 1995..2001 at every scale factor.
    return 1995, 2002


ORACLE: dict[str, str] = {
    "hourly_stats": f"{EV_CAL} " + _grain_sql("pickupdate, pickupyear, pickupmonth, pickuphour", "hourly"),
    "daily_stats": f"{LI_CAL} " + _grain_sql("pickupdate, pickupyear, pickupmonth, pickupdayofyear", "daily"),
    "daily_count": f"{LI_CAL} SELECT pickupdate, count(*) AS daily_numTrips FROM c GROUP BY pickupdate",
    "calendar_columns": f"{EV_CAL} SELECT trip_id, pickupdate, pickupyear, pickupmonth, pickupdayofyear, "
                        f"pickuphour, pickupdayofweek, week FROM c",
    "demand_flags": f"{EV_FLAGS} SELECT trip_id, pickupdate, pickuphour, isWeekend, isOvernight, isRushhour FROM f",
    "week_index_linear": f"WITH {TRIPS_LI} SELECT year(pickup_datetime) AS pickupyear, "
                         f"weekofyear(pickup_datetime) AS iso_week, "
                         f"weekofyear(pickup_datetime) + (year(pickup_datetime) - 2019) * 52 - 4 AS week, "
                         f"count(*) AS trip_count FROM trips_li GROUP BY ALL",
    "week_index_case": f"WITH {TRIPS_LI} SELECT year(pickup_datetime) AS pickupyear, "
                       f"weekofyear(pickup_datetime) AS iso_week, "
                       f"CASE year(pickup_datetime) WHEN 2019 THEN weekofyear(pickup_datetime) "
                       f"WHEN 2020 THEN weekofyear(pickup_datetime) + 48 WHEN 2021 THEN weekofyear(pickup_datetime) + 100 "
                       f"WHEN 2022 THEN weekofyear(pickup_datetime) + 152 WHEN 2023 THEN weekofyear(pickup_datetime) + 204 "
                       f"ELSE weekofyear(pickup_datetime) + 256 END AS week_case, "
                       f"CAST(date_trunc('week', pickup_datetime) AS DATE) AS week_start, "
                       f"count(*) AS trip_count FROM trips_li GROUP BY ALL",
    "holiday_dim": _holiday_values_sql(*_li_years()),
    "holiday_trips": f"{EV_CAL} SELECT pickupdate, count(*) AS trip_count FROM c "
                     f"WHERE pickupdate IN ({_date_list()}) GROUP BY pickupdate",
    "company_by_year": f"{LI_CAL} SELECT hvfhs_license_num, pickupyear, count(*) AS trip_count FROM c GROUP BY ALL",
    "company_by_hour": f"{EV_CAL} SELECT hvfhs_license_num, pickuphour, count(*) AS trip_count FROM c GROUP BY ALL",
    "company_by_dayofyear": f"{EV_CAL} SELECT hvfhs_license_num, pickupdayofyear, count(*) AS trip_count "
                            f"FROM c GROUP BY ALL",
    "company_by_month": f"{LI_CAL} SELECT hvfhs_license_num, pickupmonth, count(*) AS trip_count FROM c GROUP BY ALL",
    "month_by_weekday": f"{LI_CAL} SELECT pickupmonth, pickupdayofweek, count(*) AS trip_count FROM c GROUP BY ALL",
    "pivot_company_month": f"{EV_CAL} SELECT pickupmonth, "
                           + ", ".join(f"count(*) FILTER (WHERE hvfhs_license_num = '{k}') AS {v}"
                                       for k, v in {"HV0002": "Juno", "HV0003": "Uber", "HV0004": "Via",
                                                    "HV0005": "Lyft"}.items())
                           + " FROM c GROUP BY pickupmonth",
    "pivot_month_weekday": f"{LI_CAL} SELECT pickupmonth, monthname(make_date(2000, CAST(pickupmonth AS INTEGER), 1)) "
                           f"AS month_name, "
                           + ", ".join(f"count(*) FILTER (WHERE pickupdayofweek = {i + 1}) AS {d}"
                                       for i, d in enumerate(["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]))
                           + " FROM c GROUP BY pickupmonth",
    "weekly_series": f"{LI_CAL} SELECT week, count(*) AS count FROM c GROUP BY week",
    "pickup_zone_counts": f"WITH {TRIPS_LI}, {ZONES} SELECT z.Zone AS zone, count(*) AS pu_count FROM trips_li t "
                          f"JOIN zones z ON t.PULocationID = TRY_CAST(z.LocationID AS BIGINT) GROUP BY z.Zone",
    "dropoff_zone_counts": f"WITH {TRIPS_LI}, {ZONES} SELECT z.Zone AS zone, count(*) AS do_count FROM trips_li t "
                           f"JOIN zones z ON t.DOLocationID = TRY_CAST(z.LocationID AS BIGINT) GROUP BY z.Zone",
    "zone_flag_counts": f"{EV_FLAGS}, {ZONES} SELECT z.Zone AS zone, CAST(sum(isOvernight) AS BIGINT) AS overnight_count, "
                        f"CAST(sum(isRushhour) AS BIGINT) AS rushhour_count, "
                        f"CAST(sum(isWeekend) AS BIGINT) AS weekend_count FROM f "
                        f"JOIN zones z ON f.PULocationID = TRY_CAST(z.LocationID AS BIGINT) GROUP BY z.Zone",
    "zone_pair_counts": f"WITH {TRIPS_EV}, {ZONES} SELECT p.Zone AS PUZone, d.Zone AS DOZone, count(*) AS trip_count "
                        f"FROM trips_ev t JOIN zones p ON t.PULocationID = TRY_CAST(p.LocationID AS BIGINT) "
                        f"JOIN zones d ON t.DOLocationID = TRY_CAST(d.LocationID AS BIGINT) GROUP BY ALL",
    "join_zone": f"WITH {TRIPS_EV}, {ZONES} SELECT t.trip_id, t.PULocationID, z.Borough AS PUBorough, "
                 f"z.Zone AS PUZone FROM trips_ev t JOIN zones z ON t.PULocationID = TRY_CAST(z.LocationID AS BIGINT)",
    "zone_heat_table": f"{EV_FLAGS}, {ZONES}, "
                       f"pu AS (SELECT z.Zone AS zone, count(*) AS pu_count FROM f JOIN zones z "
                       f"ON f.PULocationID = TRY_CAST(z.LocationID AS BIGINT) GROUP BY z.Zone), "
                       f"dz AS (SELECT z.Zone AS zone, count(*) AS do_count FROM f JOIN zones z "
                       f"ON f.DOLocationID = TRY_CAST(z.LocationID AS BIGINT) GROUP BY z.Zone), "
                       f"fl AS (SELECT z.Zone AS zone, sum(isOvernight) AS overnight_count, "
                       f"sum(isRushhour) AS rushhour_count, sum(isWeekend) AS weekend_count FROM f JOIN zones z "
                       f"ON f.PULocationID = TRY_CAST(z.LocationID AS BIGINT) "
                       f"WHERE pickupdayofweek NOT IN (1, 7) GROUP BY z.Zone) "
                       f"SELECT n.Zone AS zone, CAST(coalesce(pu.pu_count, 0) AS BIGINT) AS pu_count, "
                       f"CAST(coalesce(dz.do_count, 0) AS BIGINT) AS do_count, "
                       f"CAST(coalesce(fl.overnight_count, 0) AS BIGINT) AS overnight_count, "
                       f"CAST(coalesce(fl.rushhour_count, 0) AS BIGINT) AS rushhour_count, "
                       f"CAST(coalesce(fl.weekend_count, 0) AS BIGINT) AS weekend_count "
                       f"FROM zones n LEFT JOIN pu ON n.Zone = pu.zone LEFT JOIN dz ON n.Zone = dz.zone "
                       f"LEFT JOIN fl ON n.Zone = fl.zone",
    "top_zones": f"WITH {TRIPS_LI}, {ZONES} SELECT z.Zone AS zone, count(*) AS pu_count FROM trips_li t "
                 f"JOIN zones z ON t.PULocationID = TRY_CAST(z.LocationID AS BIGINT) GROUP BY z.Zone "
                 f"ORDER BY pu_count DESC, zone ASC LIMIT 5",
    "scan_trip_count": f"WITH {TRIPS_LI} SELECT count(*) AS n_trips FROM trips_li",
    "project_trip_core": f"WITH {TRIPS_EV} SELECT trip_id, pickup_datetime, trip_miles, "
                         f"trip_time, base_passenger_fare, PULocationID FROM trips_ev",
    "drop_columns": f"WITH {TRIPS_EV} SELECT trip_id, PULocationID, trip_miles, trip_time, "
                    f"base_passenger_fare FROM trips_ev",
    "filter_year": f"WITH {TRIPS_LI} SELECT trip_id, pickup_datetime, "
                   f"base_passenger_fare FROM trips_li WHERE pickup_datetime >= TIMESTAMP '1998-01-01' "
                   f"AND pickup_datetime < TIMESTAMP '1999-01-01'",
    "filter_company": f"{EV_CAL} SELECT hvfhs_license_num, pickuphour, count(*) AS trip_count FROM c "
                      f"WHERE hvfhs_license_num = 'HV0003' GROUP BY ALL",
    "dropna_any": f"WITH {TRIPS_EV} SELECT trip_id, hvfhs_license_num, pickup_datetime, PULocationID, DOLocationID, "
                  f"trip_miles, trip_time, base_passenger_fare "
                  f"FROM trips_ev WHERE hvfhs_license_num IS NOT NULL",
    "company_labels": f"{EV_CAL} SELECT hvfhs_license_num, pickupyear, count(*) AS trip_count, "
                      f"CASE hvfhs_license_num WHEN 'HV0002' THEN 'Juno' WHEN 'HV0003' THEN 'Uber' "
                      f"WHEN 'HV0004' THEN 'Via' WHEN 'HV0005' THEN 'Lyft' END AS company FROM c GROUP BY ALL",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hourly_stats": q_hourly_stats,
    "daily_stats": q_daily_stats,
    "daily_count": q_daily_count,
    "calendar_columns": q_calendar_columns,
    "demand_flags": q_demand_flags,
    "week_index_linear": q_week_index_linear,
    "week_index_case": q_week_index_case,
    "holiday_dim": q_holiday_dim,
    "holiday_trips": q_holiday_trips,
    "company_by_year": _company("pickupyear", li=True),
    "company_by_hour": _company("pickuphour"),
    "company_by_dayofyear": _company("pickupdayofyear"),
    "company_by_month": _company("pickupmonth", li=True),
    "month_by_weekday": q_month_by_weekday,
    "pivot_company_month": q_pivot_company_month,
    "pivot_month_weekday": q_pivot_month_weekday,
    "weekly_series": q_weekly_series,
    "pickup_zone_counts": q_pickup_zone_counts,
    "dropoff_zone_counts": q_dropoff_zone_counts,
    "zone_flag_counts": q_zone_flag_counts,
    "zone_pair_counts": q_zone_pair_counts,
    "join_zone": q_join_zone,
    "zone_heat_table": q_zone_heat_table,
    "top_zones": q_top_zones,
    "scan_trip_count": q_scan_trip_count,
    "project_trip_core": q_project_trip_core,
    "drop_columns": q_drop_columns,
    "filter_year": q_filter_year,
    "filter_company": q_filter_company,
    "dropna_any": q_dropna_any,
    "company_labels": q_company_labels,
}


def _h_sql() -> str:
    return (f"h AS (SELECT pickupdate, pickupyear, pickupmonth, pickuphour, count(*) AS hourly_numTrips, "
            f"{_xsum('trip_miles')} AS hourly_total_miles, CAST(sum(trip_time) AS BIGINT) AS hourly_total_time, "
            f"{_xsum('base_passenger_fare')} AS hourly_total_base_fare, "
            f"avg(trip_miles / nullif(trip_time, 0) * 3600) AS hourly_mean_speed FROM c GROUP BY ALL)")


def _d_sql() -> str:
    return (f"d AS (SELECT pickupdate, pickupyear, pickupmonth, pickupdayofyear, count(*) AS daily_numTrips, "
            f"{_xsum('trip_miles')} AS daily_total_miles, CAST(sum(trip_time) AS BIGINT) AS daily_total_time, "
            f"{_xsum('base_passenger_fare')} AS daily_total_base_fare, "
            f"avg(trip_miles / nullif(trip_time, 0) * 3600) AS daily_mean_speed FROM c GROUP BY ALL)")


def _div(n: str, d: str) -> str:
    return f"({n}) / nullif({d}, 0)"


_RATES_SQL = (f"{_div('daily_total_base_fare', 'daily_total_miles')} AS d_base_fare_per_mile, "
              f"{_div('daily_total_base_fare', 'daily_total_time')} * 60 AS d_base_fare_per_min, "
              f"{_div('hourly_total_base_fare', 'hourly_total_miles')} AS h_base_fare_per_mile, "
              f"{_div('hourly_total_base_fare', 'hourly_total_time')} * 60 AS h_base_fare_per_min")

_MODES_SUM = " + ".join(ad.TRANSIT_MODES)

# context table at (date, hour) grain: hourly + daily + flags + rates + weather + transit
LI_CTX = (f"{LI_CAL}, {_h_sql()}, {_d_sql()}, {TRANSIT}, {WEATHER}, "
          f"ctx AS (SELECT h.pickupdate, h.pickuphour, h.hourly_numTrips, d.daily_numTrips, "
          f"{_flags_sql('h.pickupdate', 'h.pickuphour')}, {_RATES_SQL}, h.hourly_mean_speed, "
          f"w.tmax_f, w.tmin_f, w.prcp_mm, abs(w.tmax_f - 68) AS TMAXExtremity, abs(w.tmin_f - 68) AS TMINExtremity, "
          f"{', '.join('t.' + m for m in ad.TRANSIT_MODES)}, "
          f"{_div(_MODES_SUM, 'd.daily_numTrips')} AS pt_taxi_ratio "
          f"FROM h JOIN d ON h.pickupdate = d.pickupdate AND h.pickupyear = d.pickupyear "
          f"AND h.pickupmonth = d.pickupmonth JOIN weather w ON w.d = h.pickupdate "
          f"JOIN transit t ON t.d = h.pickupdate)")


def _corr_sql(cols: list[str], src: str) -> str:
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                r = f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END"
            else:
                r = f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({r}, 6) AS r FROM cc")
    complete = " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in cols)
    return f"{src}, cc AS (SELECT {', '.join(cols)} FROM jj WHERE {complete}) " + " UNION ALL ".join(parts)


ORACLE.update({
    "unit_rates": f"WITH {TRIPS_EV} SELECT trip_id, trip_miles / nullif(trip_time, 0) * 3600 AS speed, "
                  f"trip_miles * 1609.35 AS trip_meters, trip_miles * 0.621371 AS trip_km FROM trips_ev",
    "fare_rates": f"{EV_CAL}, {_h_sql()}, {_d_sql()} SELECT h.pickupdate, h.pickuphour, {_RATES_SQL} "
                  f"FROM h JOIN d ON h.pickupdate = d.pickupdate AND h.pickupyear = d.pickupyear "
                  f"AND h.pickupmonth = d.pickupmonth",
    "temp_extremity": f"WITH {WEATHER} SELECT d, abs(tmax_f - 68) AS TMAXExtremity, abs(tmin_f - 68) AS TMINExtremity "
                      f"FROM weather",
    "transit_taxi_ratio": f"{LI_CAL}, {TRANSIT}, dc AS (SELECT pickupdate, count(*) AS daily_numTrips FROM c "
                          f"GROUP BY pickupdate) SELECT dc.pickupdate, dc.daily_numTrips, "
                          f"{_div(_MODES_SUM, 'dc.daily_numTrips')} AS pt_taxi_ratio FROM dc "
                          f"JOIN transit t ON t.d = dc.pickupdate",
    "trip_duration": f"WITH {TRIPS_EV} SELECT trip_id, "
                     f"(epoch_ms(pickup_datetime + to_seconds(trip_time)) // 1000) - (epoch_ms(pickup_datetime) // 1000) "
                     f"AS duration_s FROM trips_ev",
    "yellow_adapter": f"WITH {TRIPS_EV} SELECT trip_id, trip_miles * 0.621371 AS trip_km, "
                      f"(epoch_ms(pickup_datetime + to_seconds(trip_time)) // 1000) - (epoch_ms(pickup_datetime) // 1000) "
                      f"AS trip_time, base_passenger_fare FROM trips_ev",
    "parse_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END "
                   "AS d_dmy, CAST(o_orderdate AS DATE) AS d_mdy FROM orders",
    "weather_normalise": f"WITH {WEATHER} SELECT d, tmax_f, tmin_f, prcp_mm, CAST(0 AS DOUBLE) AS snow_mm, "
                         f"CAST(NULL AS DOUBLE) AS snwd_mm FROM weather",
    "transit_normalise": f"WITH {TRANSIT} SELECT d, CASE WHEN subways_daily < 1000 THEN subways_daily END AS subways_daily, "
                         f"buses_daily, lirr_daily AS LIRR_daily, metro_north_daily, access_a_ride_daily FROM transit",
    "csv_roundtrip_dim": f"WITH {ZONES} SELECT TRY_CAST(LocationID AS BIGINT) AS PULocationID, Borough AS PUBorough, "
                         f"Zone AS PUZone FROM zones",
    "join_weather": f"{LI_CAL}, {WEATHER} SELECT c.trip_id, c.pickupdate, w.tmax_f, w.tmin_f, w.prcp_mm, "
                    f"abs(w.tmax_f - 68) AS TMAXExtremity, abs(w.tmin_f - 68) AS TMINExtremity "
                    f"FROM c JOIN weather w ON w.d = c.pickupdate",
    "join_transit": f"{LI_CAL}, {TRANSIT} SELECT c.trip_id, c.pickupdate, {', '.join('t.' + m for m in ad.TRANSIT_MODES)} "
                    f"FROM c JOIN transit t ON t.d = c.pickupdate",
    "attach_hourly": f"{EV_CAL}, {_h_sql()} SELECT c.trip_id, c.pickuphour, h.hourly_numTrips, h.hourly_total_time, "
                     f"h.hourly_total_base_fare, round(h.hourly_mean_speed, 4) AS hourly_mean_speed FROM c "
                     f"JOIN h ON c.pickupdate = h.pickupdate AND c.pickuphour = h.pickuphour "
                     f"AND c.pickupyear = h.pickupyear AND c.pickupmonth = h.pickupmonth",
    "attach_daily": f"{LI_CAL}, {_d_sql()} SELECT c.trip_id, c.pickupdate, d.daily_numTrips, d.daily_total_miles, "
                    f"d.daily_total_base_fare, round(d.daily_mean_speed, 4) AS daily_mean_speed FROM c "
                    f"JOIN d ON c.pickupdate = d.pickupdate AND c.pickupdayofyear = d.pickupdayofyear",
    "daily_count_join": f"{LI_CAL}, dc AS (SELECT pickupdate, count(*) AS daily_numTrips FROM c GROUP BY pickupdate) "
                        f"SELECT c.trip_id, c.pickupdate, dc.daily_numTrips FROM c JOIN dc USING (pickupdate)",
    "context_features": f"{LI_CTX} SELECT * REPLACE (round(hourly_mean_speed, 4) AS hourly_mean_speed) FROM ctx",
    "attach_context": f"{LI_CTX} SELECT c.trip_id, c.pickupdate, x.pt_taxi_ratio, x.TMAXExtremity, x.isWeekend, "
                      f"x.isRushhour, x.daily_numTrips FROM c JOIN ctx x ON c.pickupdate = x.pickupdate "
                      f"AND c.pickuphour = x.pickuphour",
    "correlation_matrix_wide": _corr_sql(WIDE_TRIP + WIDE_CTX, f"{LI_CTX}, jj AS (SELECT "
                                         + ", ".join(f"c.{x}" for x in WIDE_TRIP) + ", "
                                         + ", ".join(f"x.{x}" for x in WIDE_CTX)
                                         + " FROM c JOIN ctx x ON c.pickupdate = x.pickupdate "
                                           "AND c.pickuphour = x.pickuphour)"),
    **{k: _corr_sql(v, f"{LI_CTX}, jj AS (SELECT * FROM ctx)") for k, v in CORR_STAGES.items()},
    "correlation_matrix": _corr_sql(CORR_COLS, f"{LI_CTX}, jj AS (SELECT c.trip_miles, c.trip_time, "
                                               f"c.base_passenger_fare, x.daily_numTrips, x.tmax_f, x.tmin_f, "
                                               f"x.prcp_mm, x.TMINExtremity, x.pt_taxi_ratio, x.isWeekend FROM c "
                                               f"JOIN ctx x ON c.pickupdate = x.pickupdate AND c.pickuphour = x.pickuphour)"),
})

QUERIES_B = {
    "unit_rates": q_unit_rates,
    "fare_rates": q_fare_rates,
    "temp_extremity": q_temp_extremity,
    "transit_taxi_ratio": q_transit_taxi_ratio,
    "trip_duration": q_trip_duration,
    "yellow_adapter": q_yellow_adapter,
    "parse_dates": q_parse_dates,
    "weather_normalise": q_weather_normalise,
    "transit_normalise": q_transit_normalise,
    "csv_roundtrip_dim": q_csv_roundtrip_dim,
    "join_weather": q_join_weather,
    "join_transit": q_join_transit,
    "attach_hourly": q_attach_hourly,
    "attach_daily": q_attach_daily,
    "daily_count_join": q_daily_count_join,
    "context_features": q_context_features,
    "attach_context": q_attach_context,
    "correlation_matrix": q_correlation_matrix,
    "correlation_matrix_wide": q_correlation_matrix_wide,
    **{k: _correlation_stage(v) for k, v in CORR_STAGES.items()},
}


# --- oracle SQL: sources, features, models, forecasts, metrics --------------

def _share_sql(salt: str) -> str:
    """Twin of ``features.key_share`` over trip_id."""
    return f"(CAST('0x' || substr(md5('{salt}:' || coalesce(CAST(trip_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


SPLIT_SQL, SAMPLE_SQL = _share_sql("split"), _share_sql("sample")


def _bucket_sql(n: int) -> str:
    return f"CAST(floor({_share_sql('bucket')} * {n}) AS BIGINT)"


EV_FARE = (f"{EV_FLAGS}, ff AS (SELECT trip_id, trip_time, dayofyear(pickup_datetime) AS day, "
           f"hour(pickup_datetime) AS hour, isWeekend, isOvernight, isRushhour, trip_miles * 1609.35 AS trip_meters, "
           f"base_passenger_fare FROM f), tr AS (SELECT * FROM ff WHERE {SPLIT_SQL} < 0.7), "
           f"te AS (SELECT * FROM ff WHERE {SPLIT_SQL} >= 0.7)")

_LR_COEF = (f"bm AS (SELECT {_bucket_sql(16)} AS bucket, avg(trip_meters) AS m1, avg(trip_time) AS m2, "
            f"avg(base_passenger_fare) AS my, var_pop(trip_meters) AS v11, var_pop(trip_time) AS v22, "
            f"covar_pop(trip_meters, trip_time) AS c12, covar_pop(trip_meters, base_passenger_fare) AS c1y, "
            f"covar_pop(trip_time, base_passenger_fare) AS c2y FROM tr GROUP BY 1), "
            f"bc AS (SELECT bucket, m1, m2, my, (v22 * c1y - c12 * c2y) / (v11 * v22 - c12 * c12) AS b1, "
            f"(v11 * c2y - c12 * c1y) / (v11 * v22 - c12 * c12) AS b2 FROM bm), "
            f"coef AS (SELECT bucket, my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM bc)")

def _bag_sql(trees: int) -> str:
    """Rows of ``base`` once a tree ``t``, with the copies ``w`` of ``local_models.bootstrap_hashes`` and ``poisson_weights``."""
    a, digits = lm.TREES_A_HASH, 32 // lm.TREES_A_HASH
    u = (f"CAST('0x' || substr(md5('bootstrap:' || CAST(t // {a} AS VARCHAR) || ':' || coalesce(CAST(trip_id AS VARCHAR), 'null')), "
         f"1 + {digits} * (t % {a}), {digits}) AS BIGINT) / 4294967296.0::DOUBLE")
    copies = " + ".join(f"CAST(u >= {p!r}::DOUBLE AS INTEGER)" for p in lm.POISSON1.tolist())
    return f"SELECT *, {copies} AS w FROM (SELECT *, {u} AS u FROM base, (SELECT unnest(range({trees})) AS t))"


def _ml_cuts_sql(x: str, bins: int) -> str:
    """Spark ML's candidate thresholds of a column of ``base`` with few equal values, from all of up to 10,000 rows.

    Midpoints of neighbouring values: all of them, or for each of ``bins - 1`` equal steps the one whose rank lies nearest.
    """
    v = f"(SELECT x, lead(x) OVER w AS nx, upto, lead(upto) OVER w AS nupto, count(*) OVER () AS k, max(upto) OVER () AS total FROM " \
        f"(SELECT {x} AS x, sum(count(*)) OVER (ORDER BY {x}) AS upto FROM base GROUP BY {x}) WINDOW w AS (ORDER BY x))"
    return (f"SELECT (x + nx) / 2 AS cut FROM {v} WHERE nx IS NOT NULL AND k <= {bins} UNION "
            f"SELECT min((x + nx) / 2) AS cut FROM {v}, (SELECT unnest(range(1, {bins})) AS step) "
            f"WHERE nx IS NOT NULL AND k > {bins} AND upto + nupto > 2 * step * (total / {bins}) GROUP BY step")


def _tree_sql(features: list[str], depth: int, buckets: str, bins: int = 32, where: str = "TRUE", trees: int = 0, ml: bool = False) -> str:
    """CTEs that grow trees level by level over ``tr``: cut points ``e``, nodes ``n{level}`` of rows, splits ``s{level}``, node table ``nodes``.

    With ``trees``, that many bagged trees a bucket, numbered bucket x trees + tree. With ``ml``, Spark ML's candidate thresholds.
    """
    k = range(len(features))
    shares = "[" + ", ".join(f"{i / bins!r}" for i in range(1, bins)) + "]"
    xs = ", ".join(f"x{i}" for i in k)
    out = [f"base AS (SELECT row_number() OVER () AS rid, trip_id, {buckets} AS bucket, base_passenger_fare AS y, "
           + ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(features)) + f" FROM tr WHERE {where})"]
    out.append("e AS (" + " UNION ALL ".join(
        f"SELECT {i} AS f, row_number() OVER (ORDER BY cut) - 1 AS bin, cut FROM "
        + (f"({_ml_cuts_sql(f'x{i}', bins)})" if ml else f"(SELECT DISTINCT unnest(quantile_disc(x{i}, {shares})) AS cut FROM base)") for i in k) + ")")
    if trees:
        out.append(f"bag AS (SELECT rid * {trees} + t AS rid, bucket * {trees} + t AS bucket, w, y, {xs} FROM ({_bag_sql(trees)}))")
    else:
        out.append(f"bag AS (SELECT rid, bucket, 1 AS w, y, {xs} FROM base)")
    out.append("n0 AS (SELECT rid, bucket, w, y, 1 AS node, "
               + ", ".join(f"(SELECT count(*) FROM e WHERE e.f = {i} AND e.cut < x{i}) AS b{i}" for i in k) + " FROM bag WHERE w > 0)")
    tables = []
    for d in range(depth + 1):
        total = f"SELECT bucket, node, {d} AS level, sum(w) AS n, sum(w * y) AS s FROM n{d} GROUP BY bucket, node"
        if d == depth:
            tables.append(f"SELECT *, NULL AS f, NULL AS bin, NULL AS gain FROM ({total})")
            break
        out.append(f"h{d} AS (" + " UNION ALL ".join(
            f"SELECT bucket, node, {i} AS f, b{i} AS bin, CAST(sum(w) AS BIGINT) AS hn, sum(w * y) AS hs FROM n{d} GROUP BY bucket, node, b{i}" for i in k) + ")")
        out.append(f"c{d} AS (SELECT *, sum(hn) OVER o AS nl, sum(hs) OVER o AS sl, sum(hn) OVER p AS n, sum(hs) OVER p AS s FROM h{d} "
                   "WINDOW o AS (PARTITION BY bucket, node, f ORDER BY bin), p AS (PARTITION BY bucket, node, f))")
        out.append(f"g{d} AS (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM c{d} WHERE nl > 0 AND n - nl > 0)")
        out.append(f"t{d} AS (SELECT *, max(gain) OVER (PARTITION BY bucket, node) AS top FROM g{d})")
        out.append(f"s{d} AS (SELECT bucket, node, f, bin, gain FROM t{d} WHERE top > {lm.MIN_GAIN!r} AND gain >= top - {lm.GAIN_TIE!r} * abs(top) "
                   "QUALIFY row_number() OVER (PARTITION BY bucket, node ORDER BY f, bin) = 1)")
        case = "CASE s.f " + " ".join(f"WHEN {i} THEN b{i}" for i in k) + " END"
        out.append(f"n{d + 1} AS (SELECT rid, n.bucket, w, y, 2 * n.node + CASE WHEN {case} > s.bin THEN 1 ELSE 0 END AS node, "
                   + ", ".join(f"b{i}" for i in k) + f" FROM n{d} n JOIN s{d} s ON n.bucket = s.bucket AND n.node = s.node)")
        tables.append(f"SELECT a.*, s.f, s.bin, s.gain FROM ({total}) a LEFT JOIN s{d} s USING (bucket, node)")
    names = "CASE v.f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(features)) + " END"
    out.append(f"nodes AS (SELECT v.bucket, v.node, v.level, v.n, v.s, v.s / v.n AS value, {names} AS feature_name, v.f, e.cut AS threshold, v.gain "
               f"FROM ({' UNION ALL '.join(tables)}) v LEFT JOIN e ON e.f = v.f AND e.bin = v.bin)")
    return ", ".join(out)


def _forest_sql(features: list[str], n_buckets: int, n_trees: int, depth: int) -> str:
    """``_tree_sql`` and the forests' importances: ``forest`` (bucket, feature, importance, selected)."""
    return (f"{_tree_sql(features, depth, _bucket_sql(n_buckets), trees=n_trees)}, "
            "gains AS (SELECT bucket AS tree, f, sum(gain) AS gain FROM nodes WHERE f IS NOT NULL GROUP BY ALL), "
            f"shares AS (SELECT tree // {n_trees} AS bucket, f, gain / sum(gain) OVER (PARTITION BY tree) AS share FROM gains), "
            f"means AS (SELECT bucket, f, sum(share) / {n_trees} AS importance FROM shares GROUP BY ALL), "
            f"domain AS (SELECT * FROM (SELECT DISTINCT bucket FROM means), (VALUES {', '.join(f'({i}, {c!r})' for i, c in enumerate(features))}) AS v(f, feature)), "
            f"forest AS (SELECT bucket, feature, coalesce(importance, 0) AS importance, coalesce(importance, 0) >= "
            f"sum(importance) OVER (PARTITION BY bucket) / {len(features)} AS selected FROM domain LEFT JOIN means USING (bucket, f))")


def _tree_nodes_sql(cte: str) -> str:
    return (f"{cte} SELECT CAST(bucket AS BIGINT) AS bucket, CAST(node AS BIGINT) AS node, CAST(level AS BIGINT) AS level, CAST(n AS DOUBLE) AS n, "
            "round(value + 1e-9, 6) AS value, feature_name, round(threshold, 6) AS threshold, round(gain + 1e-6, 4) AS gain FROM nodes")


def _walk_sql(features: list[str], depth: int, rows: str) -> str:
    """CTEs q0 .. q{depth}: the node that each of ``rows`` (rid, bucket, y, features) reaches in ``nodes``."""
    xs = ", ".join(f"x{i}" for i in range(len(features)))
    out = [f"q0 AS (SELECT rid, bucket, 1 AS node, base_passenger_fare AS y, " + ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(features)) + f" FROM {rows})"]
    for d in range(depth):
        value = "CASE s.f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(len(features))) + " END"
        out.append(f"q{d + 1} AS (SELECT rid, q.bucket, CASE WHEN s.f IS NULL THEN q.node ELSE 2 * q.node + CASE WHEN {value} > s.threshold THEN 1 ELSE 0 END END "
                   f"AS node, y, {xs} FROM q{d} q JOIN nodes s ON q.bucket = s.bucket AND q.node = s.node)")
    return ", ".join(out)


def _tree_predictions_sql(features: list[str], depth: int, buckets: int) -> str:
    """RMSE of the mean over buckets of each test row's leaf."""
    rows = "(SELECT *, row_number() OVER () AS rid FROM te) te, (SELECT DISTINCT bucket FROM base) r"
    return (f"{EV_FARE}, {_tree_sql(features, depth, _bucket_sql(buckets))}, {_walk_sql(features, depth, rows)}, "
            f"m AS (SELECT rid, any_value(y) AS y, avg(value) AS p FROM q{depth} q JOIN nodes USING (bucket, node) GROUP BY rid) "
            "SELECT count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse FROM m")


def _global_tree_sql(target: str = "tr") -> str:
    """The global tree over the training rows of ``target``: a SELECT of ``nodes`` with Spark ML's thresholds."""
    return _tree_sql(feat.GLOBAL_FEATURES, 5, "0", ml=True).replace("FROM tr ", f"FROM {target} ")


# all rows with the value of the first tree, then the rows that it leaves to the second, and the value of that
_ALL_ROWS = "(SELECT *, trip_id AS rid, 0 AS bucket FROM ff)"
_STAGE_1 = f"st1 AS (WITH {_global_tree_sql()} SELECT * FROM nodes), v1 AS (WITH nodes AS (SELECT * FROM st1), {_walk_sql(feat.GLOBAL_FEATURES, 5, _ALL_ROWS)} " \
           "SELECT rid AS trip_id, value AS f1 FROM q5 JOIN nodes USING (bucket, node))"
_STAGE_2 = (f"{_STAGE_1}, tr2 AS (SELECT tr.* REPLACE (2 * (base_passenger_fare - f1) AS base_passenger_fare) FROM tr JOIN v1 USING (trip_id)), "
            f"st2 AS (WITH {_global_tree_sql('tr2')} SELECT * FROM nodes), v2 AS (WITH nodes AS (SELECT * FROM st2), "
            f"{_walk_sql(feat.GLOBAL_FEATURES, 5, _ALL_ROWS)} SELECT rid AS trip_id, value AS f2 FROM q5 JOIN nodes USING (bucket, node))")


def _global_sizes_sql(kind: str) -> str:
    return (f"'{kind}' AS model, (SELECT count(*) FROM tr) AS n_train, count(*) AS n_test, "
            "round(sqrt(avg(pow(base_passenger_fare - (SELECT avg(base_passenger_fare) FROM tr), 2))), 6) AS mean_rmse")


def _global_lr_sql(features: list[str]) -> str:
    """RMSE of least squares on all features: columns are made orthogonal one by one over the training rows, the label follows each."""
    k, y = len(features), len(features)
    cols = [*features, "base_passenger_fare"]
    out = ["o0 AS (SELECT trip_id, t, " + ", ".join(f"c{i} - avg(c{i}) FILTER (WHERE t) OVER () AS c{i}" for i in range(k + 1)) + " FROM (SELECT trip_id, "
           f"{SPLIT_SQL} < 0.7 AS t, " + ", ".join(f"CAST({c} AS DOUBLE) AS c{i}" for i, c in enumerate(cols)) + " FROM ff))"]
    for i in range(k):
        rest = ", ".join(f"c{j}" if j <= i else f"c{j} - c{i} * coalesce(sum(c{i} * c{j}) FILTER (WHERE t) OVER () / nullif(sum(c{i} * c{i}) FILTER (WHERE t) OVER (), 0), 0) "
                         f"AS c{j}" for j in range(k + 1))
        out.append(f"o{i + 1} AS (SELECT trip_id, t, {rest} FROM o{i})")
    return ", ".join(out) + f", residual AS (SELECT trip_id, c{y} AS e FROM o{k} WHERE NOT t)"


# trips with fare parts, context, snow and traffic, as ``tr``
_IN_CONTEXT = ("hourly_numTrips", "daily_numTrips", "isWeekend", "isOvernight", "isRushhour", "d_base_fare_per_mile", "d_base_fare_per_min", "h_base_fare_per_mile",
               "h_base_fare_per_min", "hourly_mean_speed", "tmax_f", "tmin_f", "prcp_mm", "TMAXExtremity", "TMINExtremity", *ad.TRANSIT_MODES, "pt_taxi_ratio")
VOTE_ROWS = (LI_CTX.replace(TRIPS_LI, TRIPS_LI.replace(" FROM lineitem", ", " + ", ".join(ad.FARE_PARTS_EXPRS) + " FROM lineitem"))
             + f", sn AS (SELECT CAST(o_orderdate AS DATE) AS pickupdate, {', '.join(ad.SNOW_TRAFFIC_EXPRS)} FROM orders GROUP BY 1), tr AS (SELECT c.trip_id, c.base_passenger_fare, "
             + ", ".join("c.trip_miles * 1609.35 AS trip_meters" if x == "trip_meters" else f"x.{x}" if x in _IN_CONTEXT else f"sn.{x}" if x in SNOW_TRAFFIC else f"c.{x}"
                         for x in VOTE_FEATURES)
             + " FROM c JOIN sn USING (pickupdate) JOIN ctx x ON c.pickupdate = x.pickupdate AND c.pickuphour = x.pickuphour)")

_NO_GAPS = "trip_id % 7 <> 0 AND trip_id % 11 <> 0"
LI_LAGS = (f"WITH {TRIPS_LI}, wc AS (SELECT PULocationID AS series, CAST(date_trunc('week', pickup_datetime) AS DATE) "
           f"AS week, count(*) AS n FROM trips_li GROUP BY ALL), "
           f"span AS (SELECT series, min(week) AS w0, max(week) AS w1 FROM wc GROUP BY series), "
           f"spine AS (SELECT series, CAST(g.generate_series AS DATE) AS week FROM span, "
           f"generate_series(CAST(w0 AS TIMESTAMP), CAST(w1 AS TIMESTAMP), INTERVAL 7 DAY) AS g), "
           f"filled AS (SELECT s.series, s.week, coalesce(wc.n, 0) AS n FROM spine s LEFT JOIN wc "
           f"ON s.series = wc.series AND s.week = wc.week), "
           f"lg AS (SELECT series, week, n, row_number() OVER w AS t, lag(n, 1) OVER w AS lag_1, "
           f"lag(n, 52) OVER w AS lag_52 FROM filled WINDOW w AS (PARTITION BY series ORDER BY week))")

_PAIR = "FILTER (WHERE d IS NOT NULL AND d_prev IS NOT NULL)"
FORECAST = (f"{LI_LAGS}, s1 AS (SELECT *, CASE WHEN max(t) OVER (PARTITION BY series) >= 60 THEN 52 ELSE 1 END AS s "
            f"FROM lg), s2 AS (SELECT *, CASE WHEN s = 52 THEN lag_52 ELSE lag_1 END AS y_s FROM s1), "
            f"s3 AS (SELECT *, n - y_s AS d FROM s2), "
            f"s4 AS (SELECT *, lag(d, 1) OVER (PARTITION BY series ORDER BY week) AS d_prev, "
            f"CASE WHEN s = 52 THEN lag(n, 51) OVER (PARTITION BY series ORDER BY week) ELSE n END AS y_next_s FROM s3), "
            f"fit AS (SELECT series, covar_pop(d, d_prev) {_PAIR} / nullif(var_pop(d_prev) {_PAIR}, 0) AS b, "
            f"avg(d) {_PAIR} AS md, avg(d_prev) {_PAIR} AS mdp, max(t) AS t_last, max(s) AS season FROM s4 GROUP BY series), "
            f"fit2 AS (SELECT series, b, md - b * mdp AS a, t_last, season FROM fit), "
            f"lst AS (SELECT s4.series, s4.d AS d_last, s4.y_next_s FROM s4 JOIN fit2 "
            f"ON s4.series = fit2.series AND s4.t = fit2.t_last), "
            f"sc AS (SELECT s4.series, d, d - (a + b * d_prev) AS e_ar FROM s4 JOIN fit2 ON s4.series = fit2.series "
            f"WHERE d_prev IS NOT NULL AND y_s IS NOT NULL), "
            f"st AS (SELECT series, count(*) AS n_obs, sum(d * d) AS rss_naive, sum(e_ar * e_ar) AS rss_ar FROM sc "
            f"GROUP BY series), o AS (SELECT * FROM st JOIN fit2 USING (series) JOIN lst USING (series)), "
            f"bo AS (SELECT series, 'seasonal_naive' AS model, season, n_obs, CAST(rss_naive AS DOUBLE) AS rss, "
            f"CASE WHEN rss_naive > 0 THEN n_obs * ln(rss_naive / n_obs) END AS aic, CAST(y_next_s AS DOUBLE) AS yhat_next "
            f"FROM o UNION ALL SELECT series, 'ar1_seasonal_diff' AS model, season, n_obs, rss_ar AS rss, "
            f"CASE WHEN rss_ar > 0 THEN n_obs * ln(rss_ar / n_obs) + 4 END AS aic, y_next_s + a + b * d_last AS yhat_next "
            f"FROM o), best AS (SELECT series, first(model ORDER BY aic IS NULL, aic, model) AS best_model FROM bo "
            f"GROUP BY series) SELECT bo.series, bo.model, CAST(bo.season AS BIGINT) AS season, bo.n_obs, round(bo.rss, 4) AS rss, round(bo.aic, 4) AS aic, "
            f"round(bo.yhat_next, 4) AS yhat_next, bo.model = best.best_model AS best FROM bo JOIN best USING (series)")

def _arma_sql() -> str:
    """Twin of ``forecast.forecast_arma``: columns are made orthogonal one by one within a series, over its training weeks; the week to come follows."""
    k, top = fc.LONG_AR, fc.MAX_ORDER

    def steps(name: str, source: str, cols: list[str], keep: str) -> list[str]:
        """CTEs {name}0 .. whose column y is what the columns leave of it; ``fit`` marks the rows of the fit."""
        every = [*cols, "y"]
        out = [f"{name}0 AS (SELECT {keep}, fit, " + ", ".join(f"{c} - avg({c}) FILTER (WHERE fit) OVER (PARTITION BY series) AS {c}" for c in every) + f" FROM {source})"]
        for i, c in enumerate(cols):
            b = lambda x: f"sum({c} * {x}) FILTER (WHERE fit) OVER (PARTITION BY series) / nullif(sum({c} * {c}) FILTER (WHERE fit) OVER (PARTITION BY series), 0)"  # noqa: E731,B023
            out.append(f"{name}{i + 1} AS (SELECT {keep}, fit, " + ", ".join(x if x in every[:i + 1] else f"{x} - {c} * coalesce({b(x)}, 0) AS {x}" for x in every)
                       + f" FROM {name}{i})")
        return out

    longs, used = [f"d{i}" for i in range(1, k + 1)], [f"d{i}" for i in range(1, top + 1)] + [f"e{i}" for i in range(1, top + 1)]
    win = "OVER (PARTITION BY series ORDER BY t)"
    sql = [LI_LAGS, "w0 AS (SELECT series, t, n FROM lg UNION ALL SELECT series, max(t) + 1, NULL FROM lg GROUP BY series)",
           f"w1 AS (SELECT *, CASE WHEN max(t) OVER (PARTITION BY series) > {fc.MIN_ARMA_WEEKS} THEN {fc.SEASON} ELSE 1 END AS season FROM w0)",
           f"w2 AS (SELECT *, CASE WHEN season = {fc.SEASON} THEN lag(n, {fc.SEASON}) {win} ELSE lag(n, 1) {win} END AS y_s FROM w1)",
           "w3 AS (SELECT *, CAST(n - y_s AS DOUBLE) AS d FROM w2)",
           "w4 AS (SELECT *, " + ", ".join(f"lag(d, {i}) {win} AS d{i}" for i in range(1, k + 1)) + " FROM w3)",
           f"w5 AS (SELECT *, d AS y, d IS NOT NULL AND d{k} IS NOT NULL AS fit FROM w4)", *steps("a", "w5", longs, "series, t"),
           "w6 AS (SELECT w4.*, CASE WHEN a.fit THEN a.y END AS e FROM w4 JOIN a%d a ON a.series = w4.series AND a.t = w4.t)" % k,
           "w7 AS (SELECT *, " + ", ".join(f"lag(e, {i}) {win} AS e{i}" for i in range(1, top + 1)) + " FROM w6)",
           f"w8 AS (SELECT series, t, n, season, y_s, {', '.join(used)}, coalesce(d, 0) AS y, d IS NOT NULL AS fit FROM w7 WHERE e{top} IS NOT NULL)"]
    models = []
    for p in range(top + 1):
        for q in range(top + 1):
            cols, name = [*used[:p], *used[top:top + q]], f"m{p}{q}_"
            sql += steps(name, "w8", cols, "series, n, season, y_s")
            # the week to come has y = 0: what is left of it, from the mean on, is the forecast with its sign turned
            models.append(f"SELECT series, any_value(season) AS season, {p} AS p, {q} AS q, count(*) FILTER (WHERE fit) AS n_obs, sum(y * y) FILTER (WHERE fit) AS rss, "
                          f"any_value(y_s - y) FILTER (WHERE NOT fit) AS yhat FROM {name}{len(cols)} GROUP BY series")
    sql += [f"models AS ({' UNION ALL '.join(models)})",
            "scored AS (SELECT *, CASE WHEN rss > 0 AND n_obs > p + q + 1 THEN n_obs * ln(rss / n_obs) + 2 * (p + q + 1) END AS aic FROM models)"]
    return (", ".join(sql) + " SELECT series, CAST(season AS BIGINT) AS season, CAST(p AS BIGINT) AS p, CAST(q AS BIGINT) AS q, n_obs, round(rss, 4) AS rss, round(aic, 4) AS aic, "
            "round(yhat, 4) AS yhat_next, row_number() OVER (PARTITION BY series ORDER BY aic IS NULL, aic, p + q, p) = 1 AS best FROM scored")


EXPLOG = "explog AS (SELECT " + ", ".join(ad.EXPLOG_EXPRS) + " FROM orders)"


def _means_sql(keys: str) -> str:
    return (f"m AS (SELECT model, {keys}, avg(runtime) AS runtime, avg(runtime_no_overhead) AS runtime_no_overhead, "
            f"avg(runtime) - avg(runtime_no_overhead) AS overhead FROM explog GROUP BY model, {keys})")


def _r6(c: str, alias: str | None = None) -> str:
    return f"round({c}, 6) AS {alias or c}"


_MEANS_COLS = f"{_r6('runtime')}, {_r6('runtime_no_overhead')}, {_r6('overhead')}"

ORACLE.update({
    "conform_types": f"WITH {TRIPS_EV} SELECT trip_id, CASE WHEN trip_id % 50 = 0 THEN NULL ELSE PULocationID END "
                     f"AS PULocationID, DOLocationID, CAST(trip_id % 3 AS DOUBLE) AS airport_fee, "
                     f"CAST(trip_id % 2 AS VARCHAR) AS wav_match_flag FROM trips_ev",
    "scan_conformed_union": f"WITH {TRIPS_EV}, u AS (SELECT CASE WHEN trip_id % 3 = 0 THEN '1' ELSE '0' END AS wav_match_flag, "
                            f"CAST(trip_id % 4 AS DOUBLE) AS airport_fee, PULocationID FROM trips_ev WHERE trip_id % 2 = 0 "
                            f"UNION ALL SELECT CASE WHEN trip_id % 3 = 0 THEN 'Y' ELSE 'N' END, base_passenger_fare, "
                            f"PULocationID FROM trips_ev WHERE trip_id % 2 = 1) SELECT wav_match_flag, count(*) AS n, "
                            f"{_xsum('airport_fee')} AS airport_fee_sum, CAST(sum(PULocationID) AS BIGINT) AS pu_sum "
                            f"FROM u GROUP BY wav_match_flag",
    "schema_drift": "SELECT CAST(file_index AS BIGINT) AS file_index, \"column\", prev_type, type FROM "
                    "(VALUES (1, 'PULocationID', 'int', 'string'), (1, 'airport_fee', 'int', 'double'), "
                    "(1, 'wav_match_flag', 'int', 'string')) AS v(file_index, \"column\", prev_type, type) "
                    "WHERE (SELECT count(*) FROM events) > 0",
    "empty_union_identity": f"WITH {TRIPS_EV} SELECT hvfhs_license_num, count(*) AS n, count(*) AS n_null_base "
                            f"FROM trips_ev GROUP BY hvfhs_license_num",
    "log_append_roundtrip": f"WITH {EXPLOG} SELECT model, CAST(cores AS BIGINT) AS cores, CAST(pct AS BIGINT) AS pct, "
                            f"count(*) AS n, {_xsum('runtime')} AS runtime_sum FROM explog GROUP BY ALL",
    "export_roundtrip": None,  # filled below (same text as zone_heat_table)
    "complete_features": f"WITH {TRIPS_EV} SELECT trip_id, trip_miles / nullif(trip_time, 0) * 3600 AS speed, "
                         f"trip_miles * 1609.35 AS trip_meters FROM trips_ev WHERE trip_time <> 0",
    "fare_features": f"{EV_FARE} SELECT trip_id, trip_time, day, isWeekend, isOvernight, isRushhour, trip_meters, "
                     f"base_passenger_fare FROM ff",
    "assembled_rows": f"{EV_FARE} SELECT trip_id, CAST(trip_time AS DOUBLE) AS f0, CAST(day AS DOUBLE) AS f1, "
                      f"CAST(isWeekend AS DOUBLE) AS f2, CAST(isOvernight AS DOUBLE) AS f3, "
                      f"CAST(isRushhour AS DOUBLE) AS f4, trip_meters AS f5 FROM ff",
    "train_test_split": f"WITH {TRIPS_LI} SELECT 'train' AS side, count(*) AS n_rows, {_xsum('base_passenger_fare')} "
                        f"AS fare_sum FROM trips_li WHERE {SPLIT_SQL} < 0.7 UNION ALL SELECT 'test', count(*), "
                        f"{_xsum('base_passenger_fare')} FROM trips_li WHERE {SPLIT_SQL} >= 0.7",
    "sample_by_key": f"WITH {TRIPS_LI} " + " UNION ALL ".join(
        f"SELECT CAST({p} AS BIGINT) AS pct, count(*) FILTER (WHERE {SAMPLE_SQL} < {p / 100}) AS n_rows FROM trips_li"
        for p in [10, 20, 40, 80, 100]),
    "bucket_sizes": f"WITH {TRIPS_LI} SELECT CAST({_bucket_sql(16)} AS BIGINT) AS bucket, count(*) AS n_rows "
                    f"FROM trips_li WHERE {SPLIT_SQL} < 0.7 GROUP BY 1",
    "ols_single": f"{EV_FARE} SELECT round(regr_slope(base_passenger_fare, trip_meters), 10) AS slope, "
                  f"round(regr_intercept(base_passenger_fare, trip_meters), 8) AS intercept, "
                  f"CAST(regr_count(base_passenger_fare, trip_meters) AS BIGINT) AS n FROM tr",
    "rmse": f"{EV_FARE}, o AS (SELECT regr_slope(base_passenger_fare, trip_meters) AS b, "
            f"regr_intercept(base_passenger_fare, trip_meters) AS a FROM tr) SELECT count(*) AS n, "
            f"round(sqrt(avg(pow(base_passenger_fare - (a + b * trip_meters), 2))), 6) AS rmse FROM te, o",
    "local_lr_models": f"{EV_FARE}, {_LR_COEF} SELECT CAST(bucket AS BIGINT) AS bucket, 'intercept' AS term, "
                       f"round(b0, 6) AS coef FROM coef UNION ALL SELECT bucket, 'trip_meters', round(b1, 6) FROM coef "
                       f"UNION ALL SELECT bucket, 'trip_time', round(b2, 6) FROM coef",
    "local_lr_predictions": f"{EV_FARE}, {_LR_COEF}, mc AS (SELECT avg(b0) AS b0, avg(b1) AS b1, avg(b2) AS b2 FROM coef) "
                            f"SELECT count(*) AS n, round(sqrt(avg(pow(base_passenger_fare - (b0 + trip_meters * b1 "
                            f"+ trip_time * b2), 2))), 6) AS rmse FROM te, mc",
    "tree_root_split": f"{EV_FARE}, {_tree_sql(['trip_time', 'trip_meters', 'hour'], 1, '0')} SELECT feature_name, round(threshold, 4) AS threshold, "
                       "CAST(n AS DOUBLE) AS n, round(gain, 4) AS gain FROM nodes WHERE level = 0",
    "local_tree_models": _tree_nodes_sql(f"{EV_FARE}, {_tree_sql(feat.LOCAL_FEATURES, 5, _bucket_sql(16))}"),
    "local_tree_gaps": _tree_nodes_sql(f"{EV_FARE}, {_tree_sql(feat.LOCAL_FEATURES, 3, _bucket_sql(4), where=_NO_GAPS)}"),
    "local_tree_predictions": _tree_predictions_sql(feat.LOCAL_FEATURES, 5, 16),
    "forest_importances": f"{EV_FARE}, {_forest_sql(feat.LOCAL_FEATURES, 2, 6, 4)} SELECT CAST(bucket AS BIGINT) AS bucket, feature, "
                          "round(importance, 6) AS importance, selected FROM forest",
    "feature_votes_small": f"{VOTE_ROWS}, {_forest_sql(VOTE_FEATURES, SMALL_FOREST['n_buckets'], SMALL_FOREST['n_trees'], SMALL_FOREST['depth'])} "
                           f"SELECT feature, CAST(coalesce(votes, 0) AS BIGINT) AS votes FROM (SELECT unnest([{', '.join(repr(x) for x in VOTE_DOMAIN)}]) AS feature) "
                           "LEFT JOIN (SELECT feature, count(*) AS votes FROM forest WHERE selected GROUP BY feature) USING (feature)",
    "local_lr_gaps": f"{EV_FARE}, {_LR_COEF.replace('FROM tr GROUP', f'FROM tr WHERE {_NO_GAPS} GROUP')} SELECT CAST(bucket AS BIGINT) AS bucket, "
                     "'intercept' AS term, round(b0, 6) AS coef FROM coef UNION ALL SELECT bucket, 'trip_meters', round(b1, 6) FROM coef "
                     "UNION ALL SELECT bucket, 'trip_time', round(b2, 6) FROM coef",
    "global_lr_rmse": f"{EV_FARE}, {_global_lr_sql(feat.GLOBAL_FEATURES)}, r AS (SELECT {_global_sizes_sql('lr')}, round(sqrt(avg(e * e)), 6) AS rmse "
                      "FROM te JOIN residual USING (trip_id)) SELECT *, rmse < mean_rmse AS beats_mean FROM r",
    "global_dt_rmse": f"{EV_FARE}, {_STAGE_1}, r AS (SELECT {_global_sizes_sql('dt')}, round(sqrt(avg(pow(base_passenger_fare - f1, 2))), 6) AS rmse "
                      "FROM te JOIN v1 USING (trip_id)) SELECT *, rmse < mean_rmse AS beats_mean FROM r",
    "global_gbt_rmse": f"{EV_FARE}, {_STAGE_2}, r AS (SELECT {_global_sizes_sql('gbt')}, round(sqrt(avg(pow(base_passenger_fare - f1, 2))), 6) AS rmse_1, "
                       "round(sqrt(avg(pow(base_passenger_fare - f1 - 0.1 * f2, 2))), 6) AS rmse_2 FROM te JOIN v1 USING (trip_id) JOIN v2 USING (trip_id)) "
                       "SELECT *, rmse_2 < mean_rmse AS beats_mean FROM r",
    "global_tree_nodes": f"{EV_FARE}, {_STAGE_1} SELECT CAST(node AS BIGINT) AS node, CAST(level AS BIGINT) AS level, CAST(n AS DOUBLE) AS n, round(value, 6) AS value, "
                         "feature_name, round(threshold, 6) AS threshold, round(gain, 2) AS gain FROM st1",
    "global_gbt_stages": f"{EV_FARE}, {_STAGE_2} " + " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS stage, {w}::DOUBLE AS weight, CAST(node AS BIGINT) AS node, CAST(n AS DOUBLE) AS n, round(s + 1e-9, 4) AS residual_sum, feature_name, "
        f"round(threshold, 6) AS threshold FROM st{i + 1}" for i, w in ((0, 1.0), (1, 0.1))),
    "global_lr_pair": f"{EV_FARE}, {_LR_COEF.replace(_bucket_sql(16), '0')} SELECT count(*) AS n, round(sqrt(avg(pow(base_passenger_fare - "
                      "(b0 + trip_meters * b1 + trip_time * b2), 2))), 6) AS rmse FROM te, coef",
    "weekly_lags": f"{LI_LAGS} SELECT * FROM lg",
    "forecast_naive": f"SELECT * FROM ({FORECAST}) WHERE model = 'seasonal_naive'",
    "forecast_arma": _arma_sql(),
    "forecast_ar": f"SELECT * FROM ({FORECAST}) WHERE model = 'ar1_seasonal_diff'",
    "metrics_mean_runtime": f"WITH {EXPLOG}, {_means_sql('pct')} SELECT model, CAST(pct AS BIGINT) AS pct, "
                            f"{_MEANS_COLS} FROM m",
    "metrics_size_up": f"WITH {EXPLOG}, {_means_sql('pct')} SELECT model, CAST(pct AS BIGINT) AS pct, {_MEANS_COLS}, "
                       f"{_r6('runtime / first_value(runtime) OVER w', 'size_up')}, "
                       f"{_r6('runtime_no_overhead / first_value(runtime_no_overhead) OVER w', 'size_up_no_overhead')}, "
                       f"{_r6('pct / first_value(pct) OVER w', 'ideal')} FROM m "
                       f"WINDOW w AS (PARTITION BY model ORDER BY pct)",
    "metrics_speed_up": f"WITH {EXPLOG}, {_means_sql('cores')} SELECT model, CAST(cores AS BIGINT) AS cores, "
                        f"{_MEANS_COLS}, {_r6('first_value(runtime) OVER w / runtime', 'speed_up')}, "
                        f"{_r6('first_value(runtime_no_overhead) OVER w / runtime_no_overhead', 'speed_up_no_overhead')}, "
                        f"{_r6('cores / first_value(cores) OVER w', 'ideal')} FROM m "
                        f"WINDOW w AS (PARTITION BY model ORDER BY cores)",
    "metrics_scale_up": f"WITH {EXPLOG}, {_means_sql('cores, pct')} SELECT model, CAST(cores AS BIGINT) AS cores, "
                        f"CAST(pct AS BIGINT) AS pct, {_MEANS_COLS}, "
                        f"{_r6('first_value(runtime) OVER w / runtime', 'scale_up')}, "
                        f"{_r6('first_value(runtime_no_overhead) OVER w / runtime_no_overhead', 'scale_up_no_overhead')}, "
                        f"CAST(1.0 AS DOUBLE) AS ideal FROM m WINDOW w AS (PARTITION BY model ORDER BY cores, pct)",
    "metrics_compare": f"WITH {EXPLOG}, {_means_sql('cores, pct')}, "
                       f"m2 AS (SELECT *, first_value(runtime) OVER w / runtime AS scale_up, "
                       f"first_value(runtime_no_overhead) OVER w / runtime_no_overhead AS scale_up_no_overhead FROM m "
                       f"WINDOW w AS (PARTITION BY model ORDER BY cores, pct)) "
                       f"SELECT CAST(a.cores AS BIGINT) AS cores, CAST(a.pct AS BIGINT) AS pct, "
                       + ", ".join(f"round({x}.{v}, 6) AS {v}_{x}" for x in ("lr", "dt")
                                   for v in ("runtime", "runtime_no_overhead", "overhead", "scale_up",
                                             "scale_up_no_overhead")).replace("lr.", "a.").replace("dt.", "b.")
                       + " FROM m2 a JOIN m2 b ON a.cores = b.cores AND a.pct = b.pct "
                         "WHERE a.model = 'lr' AND b.model = 'dt'",
})
ORACLE["export_roundtrip"] = ORACLE["zone_heat_table"]
ORACLE["zone_heat_files"] = (f"SELECT h.*, 'POINT (' || CAST(n_nationkey AS VARCHAR) || ' 1)' AS the_geom FROM ({ORACLE['zone_heat_table']}) h "
                             "JOIN nation ON n_name = h.zone")

QUERIES_C = {
    "conform_types": q_conform_types,
    "scan_conformed_union": q_scan_conformed_union,
    "schema_drift": q_schema_drift,
    "empty_union_identity": q_empty_union_identity,
    "log_append_roundtrip": q_log_append_roundtrip,
    "export_roundtrip": q_export_roundtrip,
    "zone_heat_files": q_zone_heat_files,
    "complete_features": q_complete_features,
    "fare_features": q_fare_features,
    "assembled_rows": q_assembled_rows,
    "train_test_split": q_train_test_split,
    "sample_by_key": q_sample_by_key,
    "bucket_sizes": q_bucket_sizes,
    "ols_single": q_ols_single,
    "rmse": q_rmse,
    "local_lr_models": q_local_lr_models,
    "local_lr_predictions": q_local_lr_predictions,
    "global_lr_rmse": q_global_lr_rmse,
    "global_dt_rmse": q_global_dt_rmse,
    "global_gbt_rmse": q_global_gbt_rmse,
    "global_tree_nodes": q_global_tree_nodes,
    "global_gbt_stages": q_global_gbt_stages,
    "local_tree_models": q_local_tree_models,
    "local_tree_predictions": q_local_tree_predictions,
    "tree_root_split": q_tree_root_split,
    "local_tree_gaps": q_local_tree_gaps,
    "local_lr_gaps": q_local_lr_gaps,
    "global_lr_pair": q_global_lr_pair,
    "feature_votes": q_feature_votes,
    "feature_votes_small": q_feature_votes_small,
    "forest_importances": q_forest_importances,
    "weekly_lags": q_weekly_lags,
    "forecast_naive": _forecast("seasonal_naive"),
    "forecast_ar": _forecast("ar1_seasonal_diff"),
    "forecast_arma": q_forecast_arma,
    "metrics_mean_runtime": q_metrics_mean_runtime,
    "metrics_size_up": q_metrics_size_up,
    "metrics_speed_up": q_metrics_speed_up,
    "metrics_scale_up": q_metrics_scale_up,
    "metrics_compare": q_metrics_compare,
}

QUERIES.update(QUERIES_B)
QUERIES.update(QUERIES_C)
# The training-data operators and their pipeline are an optional part: the
# rest of the library stands without them.
if _find_spec("farelane.llm") is not None and _find_spec("corpus_pipeline") is not None:
    import corpus_pipeline as _pipeline
    from farelane.llm import queries as _llm

    QUERIES = {**QUERIES, **_llm.QUERIES, "pipeline": _pipeline.run}
    ORACLE.update(_llm.ORACLE)
    if _pipeline.ORACLE_SQL:
        ORACLE["pipeline"] = _pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: hourly demand stats (count, miles, time, fare, speed) at sf0.001."""
    return q_hourly_stats(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES and v}
