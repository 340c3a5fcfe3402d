"""Demand counts: hourly/daily stats, company and calendar counts, pivots, zones.

Every aggregate here is a hash aggregate with a map-side partial step, so a
hot key (one hour, one company) is pre-aggregated per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import COMPANY_LABELS, WEEKDAY_NAMES, month_name
from ..functions.rates import measure_sum, speed_mph

HOUR_KEYS = ["pickupdate", "pickupyear", "pickupmonth", "pickuphour"]
DAY_KEYS = ["pickupdate", "pickupyear", "pickupmonth", "pickupdayofyear"]


def trip_measures(prefix: str, speed: Column, exact: bool = False) -> list[Column]:
    """Trips, total miles, time and fare, and mean speed of a group."""
    return [F.count("*").alias(f"{prefix}_numTrips"), measure_sum("trip_miles", exact).alias(f"{prefix}_total_miles"),
            F.sum("trip_time").alias(f"{prefix}_total_time"), measure_sum("base_passenger_fare", exact).alias(f"{prefix}_total_base_fare"),
            F.avg(speed).alias(f"{prefix}_mean_speed")]


def _speed(df: DataFrame) -> Column:
    return F.col("speed") if "speed" in df.columns else speed_mph()


def _grain_stats(df: DataFrame, keys: list[str], prefix: str, exact: bool = False) -> DataFrame:
    return df.groupBy(*keys).agg(*trip_measures(prefix, _speed(df), exact))


def hourly_stats(trips_cal: DataFrame, exact: bool = False) -> DataFrame:
    """count, total miles, time, fare and mean speed per (date, year, month, hour)."""
    return _grain_stats(trips_cal, HOUR_KEYS, "hourly", exact)


def daily_stats(trips_cal: DataFrame, exact: bool = False) -> DataFrame:
    """The same measures per (date, year, month, dayofyear)."""
    return _grain_stats(trips_cal, DAY_KEYS, "daily", exact)


def hourly_stats_rollable(trips_cal: DataFrame, exact: bool = False) -> DataFrame:
    """Hourly stats plus the speed sum and count a daily roll-up needs."""
    speed = _speed(trips_cal)
    return trips_cal.groupBy(*HOUR_KEYS).agg(*trip_measures("hourly", speed, exact), F.sum(speed).alias("_speed_sum"), F.count(speed).alias("_speed_n"))


def daily_stats_from_hourly(hourly: DataFrame) -> DataFrame:
    """Daily stats rolled up from ``hourly_stats_rollable`` (no second pass over trips).

    Counts and sums add up exactly (decimal sums stay exact); the daily mean
    speed is the summed speed over the summed count of defined speeds.
    """
    return (hourly.groupBy("pickupdate", "pickupyear", "pickupmonth").agg(
        F.sum("hourly_numTrips").alias("daily_numTrips"),
        F.sum("hourly_total_miles").alias("daily_total_miles"),
        F.sum("hourly_total_time").alias("daily_total_time"),
        F.sum("hourly_total_base_fare").alias("daily_total_base_fare"),
        F.try_divide(F.sum("_speed_sum"), F.sum("_speed_n")).alias("daily_mean_speed"))
        .withColumn("pickupdayofyear", F.dayofyear("pickupdate")))


def daily_count(trips_cal: DataFrame, date_col: str = "pickupdate") -> DataFrame:
    return trips_cal.groupBy(date_col).agg(F.count("*").alias("daily_numTrips"))


def company_counts(trips_cal: DataFrame, unit: str) -> DataFrame:
    """Trips per (company, calendar unit), ordered by the unit.

    One grouped query serves every company (the four per-company filters of a
    chart become a ``where`` on this small result).
    """
    return (trips_cal.groupBy("hvfhs_license_num", unit)
            .agg(F.count("*").alias("trip_count"))
            .orderBy(unit, "hvfhs_license_num"))


def month_weekday_counts(trips_cal: DataFrame) -> DataFrame:
    return (trips_cal.groupBy("pickupmonth", "pickupdayofweek")
            .agg(F.count("*").alias("trip_count"))
            .orderBy("pickupmonth", "pickupdayofweek"))


def pivot_company_month(trips_cal: DataFrame, labelled: bool = True) -> DataFrame:
    """Months down, companies across (listed values: a single-pass pivot)."""
    codes = list(COMPANY_LABELS)
    p = (trips_cal.groupBy("pickupmonth").pivot("hvfhs_license_num", codes).count()
         .fillna(0, subset=codes))
    if labelled:
        p = p.withColumnsRenamed(COMPANY_LABELS)
    return p.orderBy("pickupmonth")


def pivot_month_weekday(trips_cal: DataFrame) -> DataFrame:
    """Months down (number and name), weekdays across, labelled Sun..Sat by value."""
    days = list(range(1, 8))
    p = (trips_cal.groupBy("pickupmonth").pivot("pickupdayofweek", days).count()
         .fillna(0, subset=[str(d) for d in days]))
    p = p.withColumnsRenamed({str(d): WEEKDAY_NAMES[d - 1] for d in days})
    return p.withColumn("month_name", month_name("pickupmonth")).orderBy("pickupmonth")


def weekly_series(trips_cal: DataFrame, week_col: str = "week", by: list[str] | None = None) -> DataFrame:
    keys = (by or []) + [week_col]
    return trips_cal.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(*keys)


def zone_counts(trips_zoned: DataFrame, role: str = "PU") -> DataFrame:
    """Trips per pickup (PU) or dropoff (DO) zone name."""
    col = f"{role}Zone"
    name = "pu_count" if role == "PU" else "do_count"
    return trips_zoned.groupBy(F.col(col).alias("zone")).agg(F.count("*").alias(name))


def zone_flag_counts(trips_flagged_zoned: DataFrame, zone_col: str = "PUZone") -> DataFrame:
    """Per zone, the number of overnight, rush-hour and weekend trips."""
    return trips_flagged_zoned.groupBy(F.col(zone_col).alias("zone")).agg(
        F.sum("isOvernight").alias("overnight_count"),
        F.sum("isRushhour").alias("rushhour_count"),
        F.sum("isWeekend").alias("weekend_count"))


def top_n(df: DataFrame, order_cols: list, n: int) -> DataFrame:
    """First n rows under an explicit order (a top-k report)."""
    return df.orderBy(*order_cols).limit(n)
