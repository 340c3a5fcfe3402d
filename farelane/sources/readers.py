"""Readers, type conformance, drift audit and writers."""

from __future__ import annotations

from collections import OrderedDict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import DRIFT_TARGETS, LOG_CSV_SCHEMA, TRIP_SCHEMA
from ..session import local_table


#: Footers that the driver reads at a time.
FOOTERS_AT_ONCE = 16


def read_trips(spark: SparkSession, path, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; schema from the footers unless one is declared."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def conform(df: DataFrame, targets: dict | None = None) -> DataFrame:
    """Cast drifting columns to one type; text that does not parse becomes null."""
    targets = DRIFT_TARGETS if targets is None else targets
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in targets.items() if c in df.columns})


def empty_trips(spark: SparkSession, schema: StructType = TRIP_SCHEMA) -> DataFrame:
    """Empty relation with the declared trip schema (identity of union)."""
    return spark.createDataFrame([], schema)


def _footer_schemas(spark: SparkSession, paths: list[str]) -> list[tuple[int, str, StructType]]:
    """(index of the path, file, schema) of every file of every path, folders included; footers only, many at a time."""
    def schema(file: str) -> StructType:
        return spark.read.parquet(file).schema

    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        listed = list(pool.map(lambda p: sorted(spark.read.parquet(p).inputFiles()), paths))
        files = [(i, f) for i, some in enumerate(listed) for f in some]
        return [(i, f, s) for (i, f), s in zip(files, pool.map(schema, [f for _, f in files]))]


def read_trips_drifting(spark: SparkSession, paths: list[str], targets: dict | None = None,
                        columns: list[str] | None = None) -> DataFrame:
    """Read files whose column types drift, conform them, union by name.

    Files are grouped by footer schema: one scan per schema version (not per
    file), so a thousand monthly files with three versions give three scans.
    """
    groups: OrderedDict = OrderedDict()
    for _, p, s in _footer_schemas(spark, list(paths)):
        groups.setdefault(s.simpleString(), []).append(p)
    parts = []
    for ps in groups.values():
        part = conform(spark.read.parquet(*ps), targets)
        if columns:
            part = part.select(*[c for c in columns if c in part.columns])
        parts.append(part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def schema_drift(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per file, the columns whose type differs from the previous file, inside folders too.

    Output: (file_index, file, column, prev_type, type), with the index of the
    path that holds the file. Only footers are read; the comparison with the
    previous file is a ``lag`` over the file order.
    """
    from pyspark.sql.window import Window

    rows = [(at, i, p, f.name, f.dataType.simpleString())
            for at, (i, p, s) in enumerate(_footer_schemas(spark, list(paths)))
            for f in s.fields]
    df = local_table(spark, rows, "at int, file_index int, file string, column string, type string")
    w = Window.partitionBy("column").orderBy("at")
    return (df.withColumn("prev_type", F.lag("type").over(w))
            .where(F.col("prev_type").isNotNull() & (F.col("prev_type") != F.col("type")))
            .select("file_index", "file", "column", "prev_type", "type"))


def read_zone_tables(spark: SparkSession, geometry: str, *counts: str) -> list[DataFrame]:
    """The zone table (zone, the_geom) and the count tables that are joined to it, from CSV files with headers.

    Geometry stays text; every other column of a count file is a number.
    """
    zones = read_csv_strings(spark, geometry).select("zone", "the_geom")
    out = [zones]
    for path in counts:
        raw = read_csv_strings(spark, path)
        out.append(raw.select("zone", *[F.col(c).try_cast("bigint").alias(c) for c in raw.columns if c != "zone"]))
    return out


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column stays a string (no inference pass)."""
    return spark.read.option("header", True).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).csv(path)


def read_experiment_log(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    """Header-less log cores,pct,runtime,runtime_no_overhead (+ model column)."""
    df = spark.read.schema(LOG_CSV_SCHEMA).option("header", False).csv(path)
    if model is not None:
        df = df.withColumn("model", F.lit(model))
    return df


def write_table(df: DataFrame, path: str, fmt: str = "csv", partition_by=None,
                mode: str = "overwrite") -> str:
    """Export a result table (CSV with header, or Parquet)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def write_trips_partitioned(df: DataFrame, path: str, ts: str = "pickup_datetime",
                            mode: str = "overwrite") -> str:
    """Write trips as Parquet in pickup_year=/pickup_month= folders.

    A later filter on the timestamp range, or on the two partition columns,
    then skips whole folders (partition pruning) before any footer is read.
    Rows are clustered by (year, month) with a ``rebalance`` hint: AQE splits
    an oversized month (one month may hold a third of the trips) over several
    tasks instead of sending it to one.
    """
    out = df.withColumns({"pickup_year": F.year(ts), "pickup_month": F.month(ts)})
    (out.hint("rebalance", "pickup_year", "pickup_month").write.mode(mode)
     .partitionBy("pickup_year", "pickup_month").parquet(path))
    return path


def read_trips_partitioned(spark: SparkSession, path: str, first_day=None, end_day=None,
                           ts: str = "pickup_datetime") -> DataFrame:
    """Read a partitioned trip folder, pruning folders outside [first_day, end_day)."""
    df = spark.read.parquet(path)
    if first_day is not None:
        d0 = F.lit(str(first_day)).cast("date")
        df = df.where((F.col("pickup_year") * 100 + F.col("pickup_month") >= F.year(d0) * 100 + F.month(d0))
                      & (F.col(ts) >= d0.cast("timestamp_ntz")))
    if end_day is not None:
        d1 = F.lit(str(end_day)).cast("date")
        df = df.where((F.col("pickup_year") * 100 + F.col("pickup_month") <= F.year(d1) * 100 + F.month(d1))
                      & (F.col(ts) < d1.cast("timestamp_ntz")))
    return df


def append_log(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Append rows to a log table (header-less CSV or Parquet)."""
    w = df.write.mode("append")
    if fmt == "csv":
        w = w.option("header", False)
    w.format(fmt).save(path)
    return path
