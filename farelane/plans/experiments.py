"""Scalability experiments and their metrics.

Sweeps run the real fits as Spark jobs and log wall-clock times to a log
table; the metrics (means, overhead, size-up, speed-up, scale-up, model
comparison) are grouped aggregates and windows over such a log.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.features import LABEL, sample_by_key, train_test_split
from ..schemas import LOG_SCHEMA, SWEEP_SCHEMA
from ..session import local_table, materialize
from . import global_models as gm
from . import local_models as lm

# The experiment grids.
SIZES = [10, 20, 40, 80, 100]
SCALE_CORES = [1, 2, 4, 8, 10]
SPEED_CORES = [1, 2, 4, 8, 12]
PARTITIONS = [1, 2, 4, 8, 16, 32, 64, 128, 256, 512]
DEPTHS = list(range(1, 11))


# ---------------------------------------------------------------------------
# metrics over a log (model, cores, pct, runtime, runtime_no_overhead)
# ---------------------------------------------------------------------------

def mean_runtimes(log: DataFrame, keys: list[str]) -> DataFrame:
    """Mean runtimes per key and overhead = runtime - runtime_no_overhead."""
    return (log.groupBy("model", *keys)
            .agg(F.avg("runtime").alias("runtime"), F.avg("runtime_no_overhead").alias("runtime_no_overhead"))
            .withColumn("overhead", F.col("runtime") - F.col("runtime_no_overhead")))


def _first(c: str, order: list[str]):
    return F.first(c).over(Window.partitionBy("model").orderBy(*order))


def size_up(log: DataFrame) -> DataFrame:
    """T(pct)/T(smallest pct) per model; ideal = pct / smallest pct."""
    m = mean_runtimes(log, ["pct"])
    o = ["pct"]
    return m.withColumns({
        "size_up": F.col("runtime") / _first("runtime", o),
        "size_up_no_overhead": F.col("runtime_no_overhead") / _first("runtime_no_overhead", o),
        "ideal": F.col("pct") / _first("pct", o),
    })


def speed_up(log: DataFrame) -> DataFrame:
    """T(fewest cores)/T(cores) per model; ideal = cores / fewest cores."""
    m = mean_runtimes(log, ["cores"])
    o = ["cores"]
    return m.withColumns({
        "speed_up": _first("runtime", o) / F.col("runtime"),
        "speed_up_no_overhead": _first("runtime_no_overhead", o) / F.col("runtime_no_overhead"),
        "ideal": F.col("cores") / _first("cores", o),
    })


def scale_up(log: DataFrame) -> DataFrame:
    """T(first (cores, pct))/T(cores, pct) per model; ideal = 1."""
    m = mean_runtimes(log, ["cores", "pct"])
    o = ["cores", "pct"]
    return m.withColumns({
        "scale_up": _first("runtime", o) / F.col("runtime"),
        "scale_up_no_overhead": _first("runtime_no_overhead", o) / F.col("runtime_no_overhead"),
        "ideal": F.lit(1.0),
    })


def compare_models(log: DataFrame, a: str = "lr", b: str = "dt", keys=("cores", "pct")) -> DataFrame:
    """Two models side by side per key, with scale-up of each.

    Means are taken per model first and then joined 1:1 on the key (the
    means equal those of a many-to-many join of the raw logs, whose fan-out
    is uniform within a key, without emitting the pairs).
    """
    keys = list(keys)
    m = mean_runtimes(log.where(F.col("model").isin(a, b)), keys)
    w = Window.partitionBy("model").orderBy(*keys)
    m = m.withColumns({
        "scale_up": F.first("runtime").over(w) / F.col("runtime"),
        "scale_up_no_overhead": F.first("runtime_no_overhead").over(w) / F.col("runtime_no_overhead"),
    })
    vals = ["runtime", "runtime_no_overhead", "overhead", "scale_up", "scale_up_no_overhead"]
    side = {x: m.where(F.col("model") == x).select(*keys, *[F.col(v).alias(f"{v}_{x}") for v in vals])
            for x in (a, b)}
    return side[a].join(side[b], keys, "inner")


# ---------------------------------------------------------------------------
# sweeps (each fit is a Spark job; the clock is the driver's)
# ---------------------------------------------------------------------------

def _log(spark: SparkSession, rows, schema) -> DataFrame:
    if not isinstance(schema, str):
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return local_table(spark, rows, schema)


def fit_and_score_local(train: DataFrame, test: DataFrame, features: list[str], n_buckets: int,
                        model: str = "dt", depth: int = 5, label: str = LABEL, key: str = "trip_id"):
    """Fit local models on ``n_buckets`` buckets, score the test rows; (rmse, fit_s, agg_s)."""
    t0 = time.time()
    if model == "lr":
        models = materialize(lm.fit_local_lr(train, features, label, n_buckets, key))
        t1 = time.time()
        models.count()
        agg_s = time.time() - t1
        pred = lm.score_lr_ensemble(models, test)
    else:
        t1 = time.time()
        trees = lm.fit_local_trees(train, features, label, n_buckets, depth, key=key)
        agg_s = time.time() - t1
        pred = lm.score_tree_ensemble(trees, test)
    fit_s = time.time() - t0
    return gm.rmse_value(pred, label), fit_s, agg_s


def sweep_buckets(train: DataFrame, test: DataFrame, features: list[str], buckets=PARTITIONS,
                  model: str = "dt", depth: int = 5) -> DataFrame:
    """Local ensemble per bucket count: (partitions, rmse, seconds)."""
    rows = []
    for n in buckets:
        t0 = time.time()
        r, _, _ = fit_and_score_local(train, test, features, n, model, depth)
        rows.append((int(n), float(r), float(time.time() - t0)))
    return _log(train.sparkSession, rows, SWEEP_SCHEMA)


def sweep_global(train: DataFrame, test: DataFrame, features: list[str], partitions=PARTITIONS,
                 kind: str = "gbt") -> DataFrame:
    """Global model fitted on the training rows repartitioned n ways: (partitions, rmse, seconds)."""
    rows = []
    for n in partitions:
        t0 = time.time()
        model = gm.fit_global(train.repartition(n), features, kind)
        r = gm.rmse_value(gm.score(model, test))
        rows.append((int(n), float(r), float(time.time() - t0)))
    return _log(train.sparkSession, rows, SWEEP_SCHEMA)


def sweep_depth(train: DataFrame, test: DataFrame, features: list[str], n_buckets: int = 16,
                depths=DEPTHS) -> DataFrame:
    """One deepest fit; every shallower tree is its truncation. (depth, partitions, rmse, seconds)."""
    t0 = time.time()
    trees = lm.fit_local_trees(train, features, LABEL, n_buckets, max(depths))
    fit_s = time.time() - t0
    rows = []
    for d in depths:
        t1 = time.time()
        r = gm.rmse_value(lm.score_tree_ensemble(trees, test, depth=d))
        rows.append((int(d), int(n_buckets), float(r), float(fit_s + time.time() - t1)))
    return _log(train.sparkSession, rows,
                "depth int, partitions int, rmse double, seconds double")


def sweep_size(df: DataFrame, features: list[str], model: str = "lr", buckets: int = 8,
               sizes=SIZES, repeats: int = 10, key: str = "trip_id") -> DataFrame:
    """Data-size sweep: key-hash sample of pct %, 70/30 split, local fit. Log rows."""
    rows = []
    for _ in range(repeats):
        for pct in sizes:
            s = sample_by_key(df, pct / 100.0, key)
            train, test = train_test_split(s, key)
            t0 = time.time()
            _, fit_s, agg_s = fit_and_score_local(train, test, features, buckets, model)
            rows.append((model, int(buckets), int(pct), float(time.time() - t0), float(agg_s)))
    return _log(df.sparkSession, rows, LOG_SCHEMA)


def sweep_parallelism(df: DataFrame, features: list[str], model: str = "lr", cores=SPEED_CORES,
                      pct: int = 100, repeats: int = 10, key: str = "trip_id") -> DataFrame:
    """Parallelism sweep: bucket count c over all rows (the partition count, not cores)."""
    rows = []
    train, test = train_test_split(sample_by_key(df, pct / 100.0, key), key)
    for _ in range(repeats):
        for c in cores:
            t0 = time.time()
            _, fit_s, agg_s = fit_and_score_local(train, test, features, c, model)
            rows.append((model, int(c), int(pct), float(time.time() - t0), float(agg_s)))
    return _log(df.sparkSession, rows, LOG_SCHEMA)


def sweep_scale(df: DataFrame, features: list[str], model: str = "lr", cores=SCALE_CORES, sizes=SIZES,
                repeats: int = 10, key: str = "trip_id") -> DataFrame:
    """Scale-up: (buckets, pct) grow together."""
    rows = []
    for _ in range(repeats):
        for c, pct in zip(cores, sizes):
            train, test = train_test_split(sample_by_key(df, pct / 100.0, key), key)
            t0 = time.time()
            _, fit_s, agg_s = fit_and_score_local(train, test, features, c, model)
            rows.append((model, int(c), int(pct), float(time.time() - t0), float(agg_s)))
    return _log(df.sparkSession, rows, LOG_SCHEMA)

