"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.session import scratch_path

# White space separating words is space and \t \n \v \f \r.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def pieces_for(amount: float, each: float, least: int = 1) -> int:
    """How many pieces of about ``each`` make ``amount``: grows with the data, no upper limit."""
    return max(least, math.ceil((amount or 0) / each))


def keep(df: DataFrame, compression: str = "uncompressed") -> DataFrame:
    """``materialize`` with a compression of its own: none for bytes that are packed already, zstd for much that is alike."""
    path = scratch_path(df.sparkSession, "table")
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Give what a task has freed back to the system: Spark keeps Python workers for later tasks, beside which it would lie unused."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def once(c: Column) -> Column:
    """``c`` as a column that the optimizer neither copies into filters above it nor computes twice for several readers.

    Deterministic columns are inlined where a filter on them is pushed down; a
    column that a lambda reads would then be computed again for each element.
    """
    return F.when(F.monotonically_increasing_id() >= 0, c)


def running(values: str, op: str) -> str:
    """SQL: the running results of ``op`` (``+`` or ``greatest``) over a BIGINT array, in blocks of about the root of its length.

    Appending to an array copies it; blocks keep what is copied short, so n values cost little more than n steps.
    """
    def join(a: str, b: str) -> str:
        return f"{a} + {b}" if op == "+" else f"{op}({a}, {b})"

    grow = f"(a, v) -> IF(size(a) = 0, array(v), array_append(a, {join('a[size(a) - 1]', 'v')}))"
    none = "CAST(array() AS ARRAY<BIGINT>)"
    blocks = "transform(sequence(0, (size(r_all) - 1) div r_w), r_b -> slice(r_all, r_b * r_w + 1, r_w))"
    local = f"transform({blocks}, r_x -> aggregate(r_x, {none}, {grow}))"
    upto = f"aggregate(r_local, {none}, (a, x) -> IF(size(a) = 0, array(x[size(x) - 1]), array_append(a, {join('a[size(a) - 1]', 'x[size(x) - 1]')})))"
    whole = f"flatten(transform(r_local, (x, i) -> IF(i = 0, x, transform(x, v -> {join('r_upto[greatest(i - 1, 0)]', 'v')}))))"
    named = let(local, "r_local", let(upto, "r_upto", whole))
    return let(values, "r_all", f"IF(size(r_all) = 0, r_all, {let('CAST(ceil(sqrt(size(r_all))) AS INT)', 'r_w', named)})")


def let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``value``, computed once, under a name."""
    return f"transform(array({value}), {name} -> {body})[0]"
