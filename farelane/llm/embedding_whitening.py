"""Whitening of embeddings by shifted CholeskyQR (operator 13).

Vectors become whole numbers, x = floor(scale * c) + offset. Their exact
sums give the mean. The centred rows A are then made orthogonal by repeated
Gram passes over the table: G = Q'Q is summed over all tasks, G = R'R is its
Cholesky factor (of a slightly shifted G in the first pass, which makes it
definite for nearly dependent columns), and Q becomes Q R^-1 by a triangular
solve of each row. The product of the factors is the R of A = QR, and the
singular values and right vectors of that small matrix are those of A, without
the squared condition of a covariance matrix: e = s^2 / n are the eigenvalues
of the covariance, and the right vectors are the whitening components.

A pass reads the id-free vector column once and sends one d x d sum a task,
added up in two stages of bounded groups; no row is ever shuffled, and the
driver gets at most ``SUM_GROUPS`` matrices. Only the mean and the factors,
d x d each, are sent to the tasks. Rows are solved in Arrow batches, so memory
is set by the batch and d.

Defined results: vectors that are null, empty, hold a null or non-finite
entry, have another length than most (the shorter length, if two are as
frequent), or hold an entry that leaves the range of 52-bit whole numbers
take no part; null and repeated ids keep their rows; each component's sign
makes its largest entry positive (the first of equal ones); components whose
eigenvalue is zero, to the precision of a double, have no whitened value and
give no rows, so one row or equal rows give none; equal eigenvalues leave the
choice of their vectors open; ``deviation`` is null where it exceeds a long;
an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import col, keep, table

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
#: Entries of x stay below this, so that a task's sums of halves are exact longs.
LIMIT = float(1 << 52)
MAX_PASSES = 8
#: The largest entry of Q'Q - I at which rows count as orthogonal.
ORTHOGONAL = 1e-13
#: Groups into which the tasks' matrices are dealt before they are added up.
SUM_GROUPS = 64
BATCH_ROWS = 8192


@dataclass
class Whitening:
    """What the passes over the table learned: plain arrays, d long or d x d."""

    n: int
    sums: list[int]  # S, exact
    base: np.ndarray  # floor(S / n)
    rest: np.ndarray  # S - n * base
    factors: list[np.ndarray]  # R of each pass
    eigenvalues: np.ndarray  # falling, of the kept components
    vectors: np.ndarray  # components as columns
    trace: float
    orthogonality: float  # largest entry of Q'Q - I after the last pass


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x): the vectors that take part, as longs."""
    df = vectors.select(col(id_col).alias("vec_id"), col(vec_col).cast("array<double>").alias("v"))
    inside = f"v IS NOT NULL AND size(v) > 0 AND forall(v, c -> c IS NOT NULL AND abs(c) * {scale} < {LIMIT - offset!r}D)"  # false for NaN's order above all
    df = df.where(inside)
    most = df.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return df.where(F.size("v") == (most.d if most else 0)).select(
        "vec_id", F.expr(f"transform(v, c -> CAST(floor({scale} * c) AS BIGINT) + {offset}L)").alias("x"))


def _rows(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of bounded size and their vectors as a matrix of longs."""
    for b in batches:
        for k in range(0, b.num_rows, BATCH_ROWS):
            part = b.slice(k, BATCH_ROWS)
            yield part, part.column(at).flatten().to_numpy().reshape(part.num_rows, -1)


def _solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows R^-1 for an upper triangular R, by forward substitution over the columns."""
    q = np.array(rows.T, order="C")
    for j in range(len(r)):
        q[j] -= r[:j, j] @ q[:j]
        q[j] /= r[j, j]
    return q.T


def _matrix_sums(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of the doubles in column ``m`` of (k, m), first within groups of tasks, then over the groups."""

    def add(t: pa.Table) -> pa.Table:
        rows = sorted(zip(t.column("k").to_pylist(), t.column("m").to_pylist()))  # one order, so one sum
        total = np.zeros(shape).ravel()
        for _, m in rows:
            total += np.frombuffer(m)
        return pa.table([pa.array([rows[0][0]], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["k", "m"])

    some = parts.groupBy(F.pmod("k", F.lit(SUM_GROUPS))).applyInArrow(add, "k bigint, m binary").collect()
    return sum((np.frombuffer(r.m).reshape(shape) for r in sorted(some, key=lambda r: r.k)), np.zeros(shape))


def _long_sums(df: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums by dimension: each task adds the upper and lower halves of its entries as longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for _, x in _rows(batches, 0):
            n, high, low = n + len(x), high + (x >> 26).sum(axis=0), low + (x & (1 << 26) - 1).sum(axis=0)
        if n:
            yield pa.record_batch([pa.array(np.arange(len(high))), pa.array(np.full(len(high), n)), pa.array(high), pa.array(low)], ["d", "n", "high", "low"])

    parts = df.select("x").mapInArrow(run, "d bigint, n bigint, high bigint, low bigint")
    exact = "decimal(38,0)"
    rows = parts.groupBy("d").agg(*[F.sum(F.col(c).cast(exact)).alias(c) for c in ("n", "high", "low")]).collect()
    rows.sort(key=lambda r: r.d)
    return (int(rows[0].n) if rows else 0), [(int(r.high) << 26) + int(r.low) for r in rows]


def gram(df: DataFrame, base: np.ndarray, mean_rest: np.ndarray, factors: list[np.ndarray], vectors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Q'Q and column sums of Q, the centred rows solved by the factors in turn (or projected on ``vectors``), over the whole table."""
    d = len(base) if vectors is None else vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((d + 1, d))
        for _, x in _rows(batches, 0):
            q = (x - base) - mean_rest
            for r in factors:
                q = _solve(q, r)
            if vectors is not None:
                q = q @ vectors
            total[:d] += q.T @ q
            total[d] += q.sum(axis=0)
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["k", "m"])

    total = _matrix_sums(df.select("x").mapInArrow(run, "k bigint, m binary"), (d + 1, d))
    return total[:d], total[d]


def _factor(g: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper triangular R with R'R = G, shifted in the first pass and wherever G is not definite."""
    norm = float(np.linalg.norm(g, 2))
    d, unit = len(g), np.finfo(float).eps / 2
    shift = 11 * (n * d + d * (d + 1)) * unit * norm if first else 0.0
    shift = min(shift, 1e-3 * norm)  # a table of many rows must not be drowned by its own bound
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 4 * d * unit * norm)


def fit(df: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn the whitening of (vec_id, x) rows; None where there are no rows."""
    n, sums = _long_sums(df)
    if n == 0:
        return None
    d = len(sums)
    base = np.array([s // n for s in sums], np.int64)
    rest = [s - n * (s // n) for s in sums]
    mean_rest = np.array([r / n for r in rest])
    none = Whitening(n, sums, base, np.array(rest, np.int64), [], np.zeros(0), np.zeros((d, 0)), 0.0, 0.0)
    factors, r_all, last = [], np.eye(d), np.inf
    for k in range(MAX_PASSES):
        g, _ = gram(df, base, mean_rest, factors)
        if k == 0:
            if not g.any():
                return none
            trace = float(np.trace(g)) / n
        off = float(np.abs(g - np.eye(d)).max())
        if off <= ORTHOGONAL or (k >= 3 and off >= last / 2):  # as near as rounding, or a lost rank, allows
            break
        last = off
        factors.append(_factor(g, n, k == 0))
        r_all = factors[-1] @ r_all
    # what is left between Q'Q and I (rounding, or directions the rows do not span) goes in by its square root
    w, u = np.linalg.eigh(g)
    root = (u * np.sqrt(np.maximum(w, 0))) @ u.T
    _, s, vt = np.linalg.svd(root @ r_all)
    keep = s[:components] > s[0] * d * 1e-15 * n**0.5
    kept = vt[:components][keep]
    sign = np.sign(kept[np.arange(len(kept)), np.abs(kept).argmax(axis=1)])
    return Whitening(n, sums, base, np.array(rest, np.int64), factors, s[:components][keep] ** 2 / n, (kept * sign[:, None]).T, trace, off)


def identity_error(df: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance (over all rows, divisor n, centred) minus the identity."""
    k = len(model.eigenvalues)
    if k == 0:
        return 0.0
    g, s = gram(df, model.base, model.rest / model.n, [], model.vectors / np.sqrt(model.eigenvalues))
    mean = s / model.n
    return float(np.abs(g / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening | None, error: float = 0.0) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of (vec_id, x) rows."""
    id_type = df.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model.eigenvalues):
        return df.sparkSession.createDataFrame([], schema)
    n, base, rest, k = model.n, model.base, model.rest, len(model.eigenvalues)
    mean_rest, project, explained = rest / n, model.vectors / np.sqrt(model.eigenvalues), model.eigenvalues / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _rows(batches, 1):
            away = x - base
            q = away - mean_rest
            size = (n * q) ** 2
            fits = size.sum(axis=1) < 9.2e18  # below the largest long by more than the error of this sum
            with np.errstate(over="ignore"):
                deviation = ((n * away - rest) ** 2).sum(axis=1)
            rows = np.repeat(np.arange(b.num_rows), k)
            yield pa.record_batch([
                b.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), b.num_rows), pa.int32()), pa.array(np.full(len(rows), n)),
                pa.array(deviation[rows], mask=~fits[rows]), pa.array((q @ project).ravel()), pa.array(np.tile(explained, b.num_rows)),
                pa.array(np.full(len(rows), error))], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return df.select("vec_id", "x").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the first eight whitened values of every vector."""
    rows = keep(usable(table(spark, sf_dir, "embeddings")), "zstd")  # every pass reads the whole numbers
    model = fit(rows)
    return whiten(rows, model, identity_error(rows, model) if model else 0.0)
