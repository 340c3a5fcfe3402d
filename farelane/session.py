"""Session settings, durable materialisation and size-checked joins.

Everything here is plain PySpark. Two ideas recur across the library:

* ``materialize`` cuts lineage by writing a DataFrame as a Parquet table under
  the shared folder the cluster names in ``spark.checkpoint.dir``, so an
  executor loss re-reads files instead of recomputing a long plan.
* ``join_small`` broadcasts the smaller side only after counting it against a
  row bound; beyond the bound it falls back to a shuffle join that AQE can
  split for skewed keys.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast side is copied to every executor. Its row bound is the smaller
# of a row cap and a byte budget over the schema's row width, so a wide
# dimension is held to fewer rows than a narrow one.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20, min_partitions: int = 8) -> int:
    """Shuffle partitions so one partition of a full-width shuffle holds ~``target_bytes``.

    For 100 TB of trips and 256 MB targets this gives ~400k; AQE then
    coalesces the small shuffles that follow aggregation.
    """
    return max(min_partitions, -(-int(input_bytes) // int(target_bytes)))


def get_session(master: str | None = None, app: str = "farelane",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` so a
    shuffle partition stays near 128-256 MB; AQE coalesces small ones.
    """
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, reading ``spark.checkpoint.dir``.

    A folder of our own is made only when the setting is absent and the
    master is local (tests); a cluster without the setting is an error,
    because a machine-local folder would be lost with its executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Connect session: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        try:
            conf = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf = None
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        conf = tempfile.mkdtemp(prefix="farelane-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    path = os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


# Scratch tables written by this driver, by session; ``release`` deletes them.
_SCRATCH: dict[str, list[str]] = {}


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder; return its scan.

    One job (a reliable RDD checkpoint computes its last stage twice), stored
    compressed and columnar, and later reads prune columns and push filters.
    The re-read plan has no lineage to the inputs, so a lost executor costs a
    file re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def materialize_next(df: DataFrame, last: DataFrame | None) -> DataFrame:
    """``materialize`` for steps that follow each other: what ``last``, the written table of the step before, reads is deleted then."""
    table = materialize(df)
    if last is not None:
        _delete(df.sparkSession, sorted({f.rpartition("/")[0] for f in last.inputFiles()}))
    return table


def release(spark: SparkSession) -> int:
    """Delete the scratch tables this driver has written; call it when no frame that reads them is needed any more."""
    return _delete(spark, _SCRATCH.pop(spark.sparkContext.applicationId, []))


@contextmanager
def scratch_scope(spark: SparkSession):
    """Own the scratch tables written inside: they are deleted at the end, also on failure.

    For steps whose results are on the driver, or written, when they end; a
    frame that still reads such a table must not leave the scope.
    """
    paths = _SCRATCH.setdefault(spark.sparkContext.applicationId, [])
    before = len(paths)
    try:
        yield
    finally:
        mine = paths[before:]
        del paths[before:]
        _delete(spark, mine)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """What a finished job inside has shuffled leaves the disk before the next one; for steps that write or collect their results."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def bounded_rows(df: DataFrame, max_rows: int) -> int | None:
    """Row count of ``df`` if it is at most ``max_rows``, else ``None``.

    ``limit`` stops the scan early for plain tables; aggregates should be
    materialised first so the count does not recompute them. Nothing is
    remembered: a table may grow between two calls.
    """
    n = df.limit(max_rows + 1).count()
    return n if n <= max_rows else None


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "'true'" if v else "'false'"
    if isinstance(v, float):
        return "'NaN'" if v != v else f"'{v!r}'"
    return "'" + str(v).replace("'", "''") + "'"


def local_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small driver-side table (a few result or parameter rows) as one SQL VALUES relation.

    ``schema`` is "name type, ...". Values travel as text literals cast to
    their types, so floats round-trip exactly and no Python worker is needed.
    """
    fields = [f.strip().split() for f in schema.split(",")]
    names = [f[0] for f in fields]
    types = [" ".join(f[1:]) for f in fields]
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(c{i} AS {t}) AS `{n}`" for i, (n, t) in enumerate(zip(names, types)))
    alias = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({alias})")


# Bytes per value by type name (Spark's default sizes); others 100.
TYPE_BYTES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8,
              "date": 4, "timestamp": 8, "timestamp_ntz": 8, "string": 20, "binary": 100}


def _type_bytes(t) -> int:
    from pyspark.sql.types import ArrayType, DecimalType, MapType, StructType

    if isinstance(t, StructType):
        return sum(_type_bytes(f.dataType) for f in t.fields)
    if isinstance(t, ArrayType):
        return 8 * _type_bytes(t.elementType)
    if isinstance(t, MapType):
        return 8 * (_type_bytes(t.keyType) + _type_bytes(t.valueType))
    if isinstance(t, DecimalType):
        return 8 if t.precision <= 18 else 16
    return TYPE_BYTES.get(t.typeName(), 100)


def row_bytes(df: DataFrame) -> int:
    """Estimated bytes per row from the schema, plus a row header."""
    return _type_bytes(df.schema) + 8


def broadcast_row_bound(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                        max_bytes: int = BROADCAST_MAX_BYTES) -> int:
    return max(1, min(max_rows, max_bytes // row_bytes(df)))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``small`` onto ``big``, broadcasting it only under a checked bound.

    The bound is ``max_rows`` or the byte budget over the row width, whichever
    is smaller. Beyond it the join is a sort-merge join (hinted, so a low
    size estimate cannot turn it into a broadcast): it spills rather than
    holding a side in memory, and with ``spark.sql.adaptive.skewJoin.enabled``
    AQE splits a hot key's partition.
    """
    if bounded_rows(small, broadcast_row_bound(small, max_rows)) is not None:
        return big.join(F.broadcast(small), on, how)
    return big.join(small.hint("merge"), on, how)
