"""Hourly demand over a stream of trips.

The batch hourly aggregate (count, miles, time, fare, mean speed per hour) as
a Structured Streaming query: event-time tumbling windows with a watermark,
so late trips within the watermark update their hour and state for older
hours is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.rates import speed_mph
from ..operators.demand import trip_measures


def read_trip_stream(spark: SparkSession, path: str, schema: StructType,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in a folder, as a stream (schema is required)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def hourly_stats_stream(trips: DataFrame, ts: str = "pickup_datetime", watermark: str = "2 hours") -> DataFrame:
    """Per event-time hour: trips, total miles, time, fare and mean speed."""
    return (trips.withColumn("_ts", F.col(ts).cast("timestamp"))
            .withWatermark("_ts", watermark)
            .groupBy(F.window("_ts", "1 hour").alias("hour_window"))
            .agg(*trip_measures("hourly", speed_mph()))
            .select(F.col("hour_window.start").alias("hour_start"), "hourly_numTrips", "hourly_total_miles",
                    "hourly_total_time", "hourly_total_base_fare", "hourly_mean_speed"))


def write_hourly(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append finished hours to Parquet; the checkpoint makes restarts exactly-once."""
    q = (stream.writeStream.outputMode("append").format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()
