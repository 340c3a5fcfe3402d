"""Context joins: aggregates back onto trips, weather, transit, zones.

Dimension and aggregate sides are small by construction (a row per day, hour
or zone); each is counted against a row bound before it is broadcast, and
past the bound the join is a shuffle join (AQE splits skewed keys). Trips are
never joined to trips: context is built at (date, hour) grain first and then
attached N:1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import parse_date, with_demand_flags
from ..functions.rates import temp_extremity, transit_taxi_ratio, with_fare_rates
from ..schemas import TRANSIT_DROPPED, TRANSIT_RENAMES
from ..session import join_small, materialize
from .demand import (DAY_KEYS, HOUR_KEYS, daily_count, daily_stats, daily_stats_from_hourly, hourly_stats,
                     hourly_stats_rollable)

WEATHER_COLUMNS = {
    "TMAX (Degrees Fahrenheit)": "tmax_f",
    "TMIN (Degrees Fahrenheit)": "tmin_f",
    "PRCP (mm)": "prcp_mm",
    "SNOW (mm)": "snow_mm",
    "SNWD (mm)": "snwd_mm",
}


def normalise_weather(raw: DataFrame, date_fmt: str = "dd-MM-yyyy") -> DataFrame:
    """All-string weather CSV -> (d date, tmax_f, tmin_f, prcp_mm, snow_mm, snwd_mm doubles)."""
    cols = [parse_date("Date", date_fmt).alias("d")]
    cols += [F.col(f"`{src}`").try_cast("double").alias(dst)
             for src, dst in WEATHER_COLUMNS.items() if src in raw.columns]
    return raw.select(*cols)


def normalise_transit(raw: DataFrame, date_fmt: str = "MM/dd/yyyy") -> DataFrame:
    """All-string transit CSV -> short names, int counts, parsed date; share columns dropped."""
    df = raw.drop(*[c for c in TRANSIT_DROPPED if c in raw.columns])
    df = df.withColumnsRenamed({k: v for k, v in TRANSIT_RENAMES.items() if k in df.columns})
    counts = [v for v in TRANSIT_RENAMES.values() if v in df.columns]
    return df.select(parse_date("Date", date_fmt).alias("d"),
                     *[F.col(c).try_cast("int").alias(c) for c in counts])


def _attach(df: DataFrame, agg: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    # The aggregate is written once to the shared checkpoint folder: its size is
    # then checked without recomputing it, and the join re-reads the files.
    return join_small(df, materialize(agg), keys, how)


def attach_hourly(trips_cal: DataFrame, exact: bool = False) -> DataFrame:
    """Each trip with its hour's count, totals and mean speed."""
    return _attach(trips_cal, hourly_stats(trips_cal, exact), HOUR_KEYS)


def attach_daily(df: DataFrame, trips_cal: DataFrame | None = None, exact: bool = False) -> DataFrame:
    """Each row with its day's count, totals and mean speed."""
    src = trips_cal if trips_cal is not None else df
    return _attach(df, daily_stats(src, exact), DAY_KEYS)


def with_daily_count(trips_cal: DataFrame, date_col: str = "pickupdate") -> DataFrame:
    """Each trip with the number of trips on its day (group + join, not a window)."""
    return _attach(trips_cal, daily_count(trips_cal, date_col), [date_col])


def join_daily(df: DataFrame, daily: DataFrame, date_col: str = "pickupdate",
               how: str = "inner") -> DataFrame:
    """Join a daily dimension keyed ``d`` on the row's date.

    The reference keys are (year, month, dayofyear); the date is the same key
    in one column. Inner: days without a dimension row vanish.
    """
    dim = daily.withColumnRenamed("d", date_col)
    return join_small(df, dim, [date_col], how)


def join_weather(df: DataFrame, weather: DataFrame, date_col: str = "pickupdate",
                 extremity: bool = True) -> DataFrame:
    out = join_daily(df, weather, date_col)
    if extremity:
        out = out.withColumns({"TMAXExtremity": temp_extremity("tmax_f"),
                               "TMINExtremity": temp_extremity("tmin_f")})
    return out


def join_transit(df: DataFrame, transit: DataFrame, date_col: str = "pickupdate") -> DataFrame:
    return join_daily(df, transit, date_col)


def context_table(trips_cal: DataFrame, weather: DataFrame, transit: DataFrame,
                  transit_modes: list[str], holidays: DataFrame | None = None,
                  exact: bool = False) -> DataFrame:
    """One row per (date, hour): hourly and daily stats, flags, rates, weather, transit.

    Built entirely from aggregates (hours x days rows), never from trips
    joined to trips.
    """
    # One pass over the trips: hourly stats are written once, the daily ones
    # are rolled up from them (hours x days rows, never the trips again).
    h = materialize(hourly_stats_rollable(trips_cal, exact))
    d = daily_stats_from_hourly(h)
    ctx = join_small(h.drop("_speed_sum", "_speed_n"), d, ["pickupdate", "pickupyear", "pickupmonth"])
    ctx = with_demand_flags(ctx, "pickupdate", "pickuphour", holidays)
    ctx = with_fare_rates(ctx)
    ctx = join_weather(ctx, weather)
    ctx = join_transit(ctx, transit)
    return ctx.withColumn("pt_taxi_ratio", transit_taxi_ratio(transit_modes))


def attach_context(trips_cal: DataFrame, context: DataFrame,
                   keys=("pickupdate", "pickuphour"), drop_cols=()) -> DataFrame:
    """Attach (date, hour) context to trips N:1; only keys + new columns come across."""
    keys = list(keys)
    new = [c for c in context.columns if c not in trips_cal.columns and c not in drop_cols]
    return join_small(trips_cal, materialize(context.select(*keys, *new)), keys)


def zone_dim(zones_raw: DataFrame, role: str = "PU") -> DataFrame:
    """Zone lookup in a pickup or dropoff role: (<role>LocationID bigint, <role>Borough, <role>Zone)."""
    return zones_raw.select(F.col("LocationID").try_cast("bigint").alias(f"{role}LocationID"),
                            F.col("Borough").alias(f"{role}Borough"),
                            F.col("Zone").alias(f"{role}Zone"))


def join_zone(trips: DataFrame, zones_raw: DataFrame, role: str = "PU", how: str = "inner") -> DataFrame:
    """Zone names on a location id (string key cast to bigint)."""
    return join_small(trips, zone_dim(zones_raw, role), [f"{role}LocationID"], how)


def zone_activity(trips_flagged: DataFrame, zones_raw: DataFrame, flag_where=None) -> DataFrame:
    """Pickup, dropoff and pickup-flag counts per zone name in one pass over the trips.

    Each trip becomes a pickup-role and a dropoff-role row; one zone join and
    one grouped aggregate (map-side partial) give (zone, pu_count, do_count,
    overnight_count, rushhour_count, weekend_count). ``flag_where`` limits the
    trips whose flags are counted (pickup role only, as the flag table does).
    """
    keep = F.lit(True) if flag_where is None else flag_where
    roles = trips_flagged.select(F.inline(F.array(
        F.struct(F.lit("PU").alias("role"), F.col("PULocationID").alias("loc"),
                 *[F.when(keep, F.col(c)).otherwise(0).alias(c) for c in ("isOvernight", "isRushhour", "isWeekend")]),
        F.struct(F.lit("DO").alias("role"), F.col("DOLocationID").alias("loc"),
                 *[F.lit(0).alias(c) for c in ("isOvernight", "isRushhour", "isWeekend")]))))
    z = zone_dim(zones_raw, "X").withColumnRenamed("XLocationID", "loc")
    j = join_small(roles, z, ["loc"])
    pu = F.col("role") == "PU"
    return j.groupBy(F.col("XZone").alias("zone")).agg(
        F.count_if(pu).alias("pu_count"),
        F.count_if(~pu).alias("do_count"),
        F.sum("isOvernight").alias("overnight_count"),
        F.sum("isRushhour").alias("rushhour_count"),
        F.sum("isWeekend").alias("weekend_count"))


def zone_heat_table(zone_names: DataFrame, *counts: DataFrame) -> DataFrame:
    """Zone table left-joined with count tables keyed by ``zone``; misses become 0.

    The count tables may be separate (pickup, dropoff, flags) or the single
    table of ``zone_activity``.
    """
    out = zone_names
    for side in counts:
        out = join_small(out, side, ["zone"], "left")
    counts = [c for c in out.columns if c.endswith("_count")]
    return out.fillna(0, subset=counts).withColumns({c: F.col(c).cast("int") for c in counts})

