"""Declared schemas for trips, dimensions and experiment logs."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# Canonical ride-hail trip schema, after type conformance.
TRIP_SCHEMA = _s(
    ("hvfhs_license_num", StringType()),
    ("dispatching_base_num", StringType()),
    ("originating_base_num", StringType()),
    ("request_datetime", TimestampNTZType()),
    ("on_scene_datetime", TimestampNTZType()),
    ("pickup_datetime", TimestampNTZType()),
    ("dropoff_datetime", TimestampNTZType()),
    ("PULocationID", LongType()),
    ("DOLocationID", LongType()),
    ("trip_miles", DoubleType()),
    ("trip_time", LongType()),
    ("base_passenger_fare", DoubleType()),
    ("tolls", DoubleType()),
    ("bcf", DoubleType()),
    ("sales_tax", DoubleType()),
    ("congestion_surcharge", DoubleType()),
    ("airport_fee", DoubleType()),
    ("tips", DoubleType()),
    ("driver_pay", DoubleType()),
    ("shared_request_flag", StringType()),
    ("shared_match_flag", StringType()),
    ("access_a_ride_flag", StringType()),
    ("wav_request_flag", StringType()),
    ("wav_match_flag", StringType()),
)

# Columns whose type drifts between monthly files, and the type adopted.
DRIFT_TARGETS = {
    "wav_match_flag": "string",
    "airport_fee": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
}

# Yellow-taxi columns used, as (source name, canonical name, type).
YELLOW_COLUMNS = [
    ("tpep_pickup_datetime", "pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "dropoff_datetime", "timestamp_ntz"),
    ("trip_distance", "trip_miles", "double"),
    ("fare_amount", "base_passenger_fare", "double"),
]

# Header-less experiment log as written by timing runs.
LOG_CSV_SCHEMA = _s(
    ("cores", IntegerType()),
    ("pct", IntegerType()),
    ("runtime", DoubleType()),
    ("runtime_no_overhead", DoubleType()),
)

# The same log with the model it belongs to.
LOG_SCHEMA = _s(
    ("model", StringType()),
    ("cores", IntegerType()),
    ("pct", IntegerType()),
    ("runtime", DoubleType()),
    ("runtime_no_overhead", DoubleType()),
)

# Header-less sweep log: one row per partition/bucket count.
SWEEP_SCHEMA = _s(
    ("partitions", IntegerType()),
    ("rmse", DoubleType()),
    ("seconds", DoubleType()),
)

ZONE_CSV_SCHEMA = _s(
    ("LocationID", StringType()),
    ("Borough", StringType()),
    ("Zone", StringType()),
    ("service_zone", StringType()),
)

# Raw daily CSV column names (fixed values of the public source files).
WEATHER_CSV_COLUMNS = [
    "Date", "TMAX (Degrees Fahrenheit)", "TMIN (Degrees Fahrenheit)",
    "PRCP (mm)", "SNOW (mm)", "SNWD (mm)",
    "PRCP (Inches)", "SNOW (Inches)", "SNWD (Inches)",
]

# Transit CSV: total columns renamed to short names; share-of-normal columns dropped.
TRANSIT_RENAMES = {
    "Subways: Total Estimated Ridership": "subways_daily",
    "Buses: Total Estimated Ridership": "buses_daily",
    "LIRR: Total Estimated Ridership": "LIRR_daily",
    "Metro-North: Total Estimated Ridership": "metro_north_daily",
    "Access-A-Ride: Total Scheduled Trips": "access_a_ride_daily",
    "Bridges and Tunnels: Total Traffic": "br_tunnel_traffic",
    "Staten Island Railway: Total Estimated Ridership": "SIR_daily",
}
TRANSIT_DROPPED = [
    "Subways: % of Comparable Pre-Pandemic Day",
    "Buses: % of Comparable Pre-Pandemic Day",
    "LIRR: % of Comparable Pre-Pandemic Day",
    "Metro-North: % of Comparable Pre-Pandemic Day",
    "Access-A-Ride: % of Comparable Pre-Pandemic Day",
    "Bridges and Tunnels: % of Comparable Pre-Pandemic Day",
    "Staten Island Railway: % of Comparable Pre-Pandemic Day",
]
