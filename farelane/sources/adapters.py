"""Adapters from the TPC-H-style driver tables to the trip and dimension shapes.

The expressions are the ones documented in FIXTURES.md; they are written as
SQL expression strings so the DuckDB checks can reuse the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_small, materialize

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Hour-level trips from the events table.
TRIPS_EV_EXPRS = [
    "event_id AS trip_id",
    "CASE event_type WHEN 'click' THEN 'HV0002' WHEN 'view' THEN 'HV0003' "
    "WHEN 'purchase' THEN 'HV0004' WHEN 'signup' THEN 'HV0005' END AS hvfhs_license_num",
    "ts AS pickup_datetime",
    "user_id % 25 AS PULocationID",
    "(user_id * 7 + event_id) % 25 AS DOLocationID",
    "value / 10 AS trip_miles",
    "(event_id * 37) % 3600 AS trip_time",
    "2.5 + 0.175 * value + 0.01 * ((event_id * 37) % 3600) + 0.5 * (event_id % 7) AS base_passenger_fare",
]

# Multi-year trips from lineitem x supplier.
TRIPS_LI_EXPRS = [
    "l_orderkey * 31 + l_partkey * 7 + l_suppkey * 3 + l_linenumber AS trip_id",
    "l_returnflag AS hvfhs_license_num",
    "l_shipdate AS pickup_datetime",
    "CAST(s_nationkey AS BIGINT) AS PULocationID",
    "l_partkey % 25 AS DOLocationID",
    "l_quantity AS trip_miles",
    "(l_partkey % 60) * 60 AS trip_time",
    "l_extendedprice AS base_passenger_fare",
]

# Stand-ins for the parts of a fare, which the tables do not hold.
FARE_PARTS_EXPRS = [
    "CAST(l_linenumber % 4 AS DOUBLE) * 6.5 AS tolls",
    "CAST(l_partkey % 50 AS DOUBLE) / 20 AS bcf",
    "l_tax * l_extendedprice AS sales_tax",
    "CAST(CASE WHEN l_partkey % 3 = 0 THEN 2.75 ELSE 0 END AS DOUBLE) AS congestion_surcharge",
    "CAST(CASE WHEN s_nationkey % 8 = 1 THEN 2.5 ELSE 0 END AS DOUBLE) AS airport_fee",
    "l_discount * l_extendedprice AS tips",
    "CAST(l_quantity * 10 + l_partkey % 90 AS DOUBLE) AS driver_pay",
]

ZONES_EXPRS = [
    "CAST(n_nationkey AS STRING) AS LocationID",
    "r_name AS Borough",
    "n_name AS Zone",
]

TRANSIT_AGGS = [
    ("subways_daily", "1-URGENT"),
    ("buses_daily", "2-HIGH"),
    ("lirr_daily", "3-MEDIUM"),
    ("metro_north_daily", "4-NOT SPECIFIED"),
    ("access_a_ride_daily", "5-LOW"),
]
TRANSIT_MODES = [m for m, _ in TRANSIT_AGGS]


def trips_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*TRIPS_EV_EXPRS)


def trips_li(spark: SparkSession, sf_dir: str, fare_parts: bool = False) -> DataFrame:
    """Multi-year trips, on demand with the parts of their fares."""
    extra = ["l_tax", "l_discount"] if fare_parts else []
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        "l_shipdate", "l_quantity", "l_extendedprice", *extra)
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # supplier grows with the scale factor: broadcast only under the row bound.
    joined = join_small(li, sup, li.l_suppkey == sup.s_suppkey)
    return joined.selectExpr(*TRIPS_LI_EXPRS, *(FARE_PARTS_EXPRS if fare_parts else []))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return join_small(n, r, n.n_regionkey == r.r_regionkey).selectExpr(*ZONES_EXPRS)


def daily_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridership by mode and the weather stand-in, one row per order date, from one pass over orders, written once."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderpriority", "o_custkey")
    s = F.sum("o_custkey")
    return materialize(o.groupBy(F.to_date("o_orderdate").alias("d")).agg(
        *[F.count_if(F.col("o_orderpriority") == p).alias(m) for m, p in TRANSIT_AGGS],
        (F.lit(20) + s % 80).cast("double").alias("tmax_f"), (s % 60).cast("double").alias("tmin_f"), F.count("*").cast("double").alias("prcp_mm")))


def transit(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """Daily ridership by mode; ``daily`` is a ``daily_dimensions`` table at hand."""
    return (daily if daily is not None else daily_dimensions(spark, sf_dir)).select("d", *TRANSIT_MODES)


def weather(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """Deterministic daily weather stand-in."""
    return (daily if daily is not None else daily_dimensions(spark, sf_dir)).select("d", "tmax_f", "tmin_f", "prcp_mm")


# Daily stand-ins for snow and for bridge and tunnel traffic, from orders grouped by date.
SNOW_TRAFFIC_EXPRS = [
    "CAST(sum(o_orderkey) % 40 AS DOUBLE) AS snow_mm",
    "CAST(sum(o_orderkey) % 90 AS DOUBLE) AS snwd_mm",
    "CAST(count(*) * 7 + sum(o_custkey) % 13 AS DOUBLE) AS br_tunnel_traffic",
]


def snow_and_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pickupdate, snow_mm, snwd_mm, br_tunnel_traffic), one row per order date, written once."""
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("pickupdate"), "o_orderkey", "o_custkey")
    return materialize(o.groupBy("pickupdate").agg(*[F.expr(e.rpartition(" AS ")[0]).alias(e.rpartition(" AS ")[2]) for e in SNOW_TRAFFIC_EXPRS]))


# Experiment-log stand-in from orders: (model, cores, pct, runtime, runtime_no_overhead).
EXPLOG_EXPRS = [
    "CASE WHEN o_orderkey % 2 = 0 THEN 'lr' ELSE 'dt' END AS model",
    "CAST(CASE o_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 8 ELSE 10 END AS INT) AS cores",
    "CAST(CASE o_orderkey % 5 WHEN 0 THEN 10 WHEN 1 THEN 20 WHEN 2 THEN 40 WHEN 3 THEN 80 ELSE 100 END AS INT) AS pct",
    "o_totalprice / 1000 AS runtime",
    "o_totalprice / 1250 AS runtime_no_overhead",
]


def experiment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*EXPLOG_EXPRS)
