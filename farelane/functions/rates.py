"""Unit conversions, rates and ratios as guarded column expressions.

Spark 4 runs with ANSI mode on, where ``/`` raises on a zero divisor; every
ratio here goes through ``try_divide`` and yields null instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
METERS_PER_MILE = 1609.35
# The yellow-taxi scripts multiply miles by the km->mile factor and call it km.
KM_FACTOR = 0.621371
COMFORT_TEMP_F = 68
SECONDS_PER_HOUR = 3600
SECONDS_PER_MINUTE = 60


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def measure_sum(c, exact: bool = False, scale: int = 6) -> Column:
    """Sum of a double measure.

    ``exact`` sums ``decimal(38, scale)`` values: the total no longer depends on
    the order rows meet in partial aggregates, so it is the same for any
    partitioning or cluster size (and equal to a SQL engine's decimal sum).
    """
    c = _c(c)
    if exact:
        return F.sum(c.cast(f"decimal(38,{scale})")).cast("double")
    return F.sum(c)


def safe_div(n, d) -> Column:
    return F.try_divide(_c(n), _c(d))


def trip_duration(dropoff, pickup) -> Column:
    """Seconds between two timestamps."""
    return F.unix_timestamp(_c(dropoff)) - F.unix_timestamp(_c(pickup))


def speed_mph(miles="trip_miles", seconds="trip_time") -> Column:
    return safe_div(miles, seconds) * SECONDS_PER_HOUR


def trip_meters(miles="trip_miles") -> Column:
    return _c(miles) * METERS_PER_MILE


def trip_km(miles="trip_miles") -> Column:
    return _c(miles) * KM_FACTOR


def per_mile(fare, miles) -> Column:
    return safe_div(fare, miles)


def per_minute(fare, seconds) -> Column:
    return safe_div(fare, seconds) * SECONDS_PER_MINUTE


def temp_extremity(temp_f) -> Column:
    """Distance from a comfortable 68 F."""
    return F.abs(_c(temp_f) - COMFORT_TEMP_F)


def with_unit_rates(df: DataFrame) -> DataFrame:
    """speed (mph), trip_meters and trip_km from trip_miles/trip_time."""
    return df.withColumns({
        "speed": speed_mph(),
        "trip_meters": trip_meters(),
        "trip_km": trip_km(),
    })


def with_fare_rates(df: DataFrame) -> DataFrame:
    """Daily and hourly base fare per mile and per minute from grain totals."""
    return df.withColumns({
        "d_base_fare_per_mile": per_mile("daily_total_base_fare", "daily_total_miles"),
        "d_base_fare_per_min": per_minute("daily_total_base_fare", "daily_total_time"),
        "h_base_fare_per_mile": per_mile("hourly_total_base_fare", "hourly_total_miles"),
        "h_base_fare_per_min": per_minute("hourly_total_base_fare", "hourly_total_time"),
    })


def transit_taxi_ratio(modes: list[str], trips="daily_numTrips") -> Column:
    """Sum of public-transport riders over the day's taxi trips."""
    total = _c(modes[0])
    for m in modes[1:]:
        total = total + _c(m)
    return safe_div(total, trips)
