"""Feature tables, complete rows, key-hash split/sample/buckets, correlation.

Splits, samples and buckets are functions of a row key, not of the row's
position or of a random stream: the same row lands on the same side for any
partitioning, retry or cluster size.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import with_demand_flags
from ..functions.rates import trip_duration, trip_km, trip_meters
from ..schemas import TRIP_SCHEMA
from ..session import local_table, materialize, scratch_scope
from .moments import correlations, keyed_moments, moments, moments_with_constants

GLOBAL_FEATURES = ["trip_time", "day", "isWeekend", "isOvernight", "isRushhour", "trip_meters"]
LOCAL_FEATURES = ["trip_time", "trip_meters", "hour", "isWeekend", "isOvernight", "isRushhour"]
LABEL = "base_passenger_fare"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed rule: a share is the first 52 bits of an MD5 digest, which a double holds exactly.
SHARE_DIGITS, SHARE_RANGE = 13, 2.0**52


def key_share(key, salt: str) -> Column:
    """A uniform number in [0, 1) for a row key, independent for each salt.

    It depends on all digits of the key, so keys in steps fall evenly too, and
    it is the same in any engine that has MD5. Null keys share one number.
    """
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(_c(key).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, SHARE_DIGITS), 16, 10).cast("double") / F.lit(SHARE_RANGE)


def with_trip_key(df: DataFrame, name: str = "trip_id", cols: list[str] | None = None) -> DataFrame:
    """Add a row key from the columns that tell trips apart (all those of the trip schema that ``df`` has, or ``cols``).

    Repeated rows get one key: they are the same trip.
    """
    known = [f.name for f in TRIP_SCHEMA.fields]
    cols = cols or [c for c in known if c in df.columns] or df.columns
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]
    return df.withColumn(name, F.xxhash64(F.concat_ws("|", *parts)))


def bucket_of(key, n: int) -> Column:
    """Bucket in [0, n)."""
    return F.floor(key_share(key, "bucket") * n).cast("int")


def train_test_split(df: DataFrame, key: str = "trip_id", train_fraction: float = 0.7):
    """Deterministic split by key hash: train where the key's share is under the fraction."""
    share = key_share(key, "split")
    return df.where(share < train_fraction), df.where(share >= train_fraction)


def with_side(df: DataFrame, key: str = "trip_id", train_fraction: float = 0.7, name: str = "side") -> DataFrame:
    """The sides of ``train_test_split`` as a column, ``train`` or ``test``: one pass serves both."""
    return df.withColumn(name, F.when(key_share(key, "split") < train_fraction, "train").otherwise("test"))


def sample_by_key(df: DataFrame, fraction: float, key: str = "trip_id") -> DataFrame:
    """Reproducible Bernoulli-like sample: rows whose key's share falls under the fraction."""
    return df.where(key_share(key, "sample") < fraction)


def sample_sizes(df: DataFrame, fractions, key: str = "trip_id") -> DataFrame:
    """Rows kept by ``sample_by_key`` for each fraction, in one pass: (pct, n_rows)."""
    share = key_share(key, "sample")
    row = df.agg(*[F.count_if(share < f).alias(f"n{round(f * 100)}") for f in fractions])
    return row.select(F.inline(F.array(*[F.struct(F.lit(round(f * 100)).alias("pct"), F.col(f"n{round(f * 100)}").alias("n_rows"))
                                         for f in fractions])))


def with_bucket(df: DataFrame, n: int, key: str = "trip_id", name: str = "bucket") -> DataFrame:
    return df.withColumn(name, bucket_of(key, n))


def bucket_sizes(df: DataFrame, n: int, key: str = "trip_id") -> DataFrame:
    return with_bucket(df, n, key).groupBy("bucket").agg(F.count("*").alias("n_rows"))


def complete_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of ``cols`` (listwise deletion)."""
    return df.dropna(subset=list(cols))


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Vector of ``cols``; rows with null/NaN are skipped."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def fare_features(trips: DataFrame, calendar: str = "day", holidays: DataFrame | None = None,
                  keep=("trip_id",)) -> DataFrame:
    """Model table: trip_time, day-of-year or hour, flags, trip_meters, label fare."""
    t = F.col("pickup_datetime")
    df = trips.withColumns({
        "day": F.dayofyear(t), "hour": F.hour(t), "year": F.year(t),
        "Date": F.to_date(t), "trip_meters": trip_meters("trip_miles"),
    })
    df = with_demand_flags(df, "Date", "hour", holidays)
    feats = GLOBAL_FEATURES if calendar == "day" else LOCAL_FEATURES
    return df.select(*[k for k in keep if k in df.columns], *feats, LABEL)


def yellow_features(yellow: DataFrame, keep=()) -> DataFrame:
    """Two-feature table from yellow-taxi columns: trip_km, trip_time (s), label fare."""
    return yellow.select(
        *keep,
        trip_km("trip_miles").alias("trip_km"),
        trip_duration("dropoff_datetime", "pickup_datetime").alias("trip_time"),
        F.col("base_passenger_fare"))


def adapt(df: DataFrame, spec) -> DataFrame:
    """Rename + cast from a list of (old, new, type)."""
    return df.select(*[F.col(o).try_cast(t).alias(n) for o, n, t in spec])


def correlation_long(df: DataFrame, cols: list[str], complete: bool = True) -> DataFrame:
    """Pearson correlation of every pair of ``cols`` as (col_a, col_b, r), in one pass.

    Rows with a null or NaN in any column are left out first (listwise). Each
    task folds its rows into one set of moments, batch by batch.
    """
    src = complete_features(df.select(*cols), cols) if complete else df.select(*cols)
    return local_table(df.sparkSession, correlations(moments(src, cols), cols), "col_a string, col_b string, r double")


def correlation_with_context(trips: DataFrame, context: DataFrame, trip_cols: list[str], context_cols: list[str],
                             keys=("pickupdate", "pickuphour")) -> DataFrame:
    """``correlation_long`` over trips with their N:1 context, without joining trips to it.

    One pass folds the trips of each key into arrays of moments inside the
    tasks; context columns are constant within a key, so what a task has of a
    key joins its context and all of it folds into one set of moments.
    """
    keys = list(keys)
    rows = complete_features(trips.select(*{*keys, *trip_cols}), trip_cols)
    side = complete_features(context.select(*keys, *context_cols), context_cols)
    with scratch_scope(trips.sparkSession):
        state = _state_with_context(rows, side, keys, trip_cols, context_cols)
    return local_table(trips.sparkSession, correlations(state, [*trip_cols, *context_cols]), "col_a string, col_b string, r double")


def _state_with_context(rows: DataFrame, side: DataFrame, keys: list[str], trip_cols: list[str], context_cols: list[str]):
    side = materialize(side)
    # the keys' names are kept apart from columns that are correlated too
    side = side.select(*[F.col(c).alias(f"key_{i}") for i, c in enumerate(keys)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(context_cols)])
    rows = rows.select(*[F.col(c).alias(f"key_{i}") for i, c in enumerate(keys)], *[F.col(c).alias(f"x{i}") for i, c in enumerate(trip_cols)])
    names = [f"key_{i}" for i in range(len(keys))]
    parts = materialize(keyed_moments(rows, names, [f"x{i}" for i in range(len(trip_cols))]).join(side, names))
    return moments_with_constants(parts, len(trip_cols), [f"c{i}" for i in range(len(context_cols))])
