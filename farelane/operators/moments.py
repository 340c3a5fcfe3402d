"""Counts, means and co-moments of many columns as arrays, folded inside tasks and merged.

A state is (n, m, w): rows, means, and the sums of products of deviations of
the column pairs i <= j, in order. States merge by the pairwise update
formulas, so no pass centres the data first and no sum of squares cancels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staged_merge import merge_in_stages, task_count

#: Keys whose moments a task holds before it hands them on.
HELD_KEYS = 100_000


def pairs(k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(k)


def fold_all(n: np.ndarray, m: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """One state from many: those within them, and that of their means."""
    i, j = pairs(m.shape[1])
    total = n.sum()
    if not total:
        return 0.0, np.zeros(m.shape[1]), np.zeros(len(i))
    mean = (n[:, None] * m).sum(axis=0) / total
    d = m - mean
    return float(total), mean, w.sum(axis=0) + ((n[:, None] * d).T @ d)[i, j]


def _rows(b: pa.RecordBatch, first: int) -> np.ndarray:
    return np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[first:]], axis=1)


def _state_batch(part: int, states: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array([part] * len(states), pa.int64()), pa.array([s[0] for s in states], pa.float64()),
                            pa.array([s[1].tobytes() for s in states], pa.binary()), pa.array([s[2].tobytes() for s in states], pa.binary())],
                           ["part", "n", "m", "w"])


def keyed_moments(rows: DataFrame, keys: list[str], cols: list[str], held_keys: int = HELD_KEYS) -> DataFrame:
    """(keys, n, m, w as array<double>): moments of ``cols`` by key, one row per task and key it meets; null keys are left out."""
    k, (i, j) = len(keys), pairs(len(cols))

    def run(batches):
        place: dict[tuple, int] = {}
        n, m, w = np.zeros(0), np.zeros((0, len(cols))), np.zeros((0, len(i)))

        def hand_on():
            names = list(zip(*place)) or [()] * k
            out = pa.record_batch([*[pa.array(v, types[c]) for c, v in enumerate(names)], pa.array(n[:len(place)]),
                                   pa.array(list(m[:len(place)]), pa.list_(pa.float64())), pa.array(list(w[:len(place)]), pa.list_(pa.float64()))],
                                  [*keys, "n", "m", "w"])
            place.clear()
            return out

        for b in batches:
            if not b.num_rows:
                continue
            types = [c.type for c in b.columns[:k]]
            code = np.zeros(b.num_rows, np.int64)
            for c in b.columns[:k]:
                d = c.dictionary_encode()
                code = code * len(d.dictionary) + d.indices.to_numpy()
            _, at, of = np.unique(code, return_index=True, return_inverse=True)
            named = list(zip(*[c.take(pa.array(at)).to_pylist() for c in b.columns[:k]]))
            order = np.argsort(of, kind="stable")
            starts = np.searchsorted(of[order], np.arange(len(at)))
            x = _rows(b, k)[order]
            count = np.diff(starts, append=len(x)).astype(float)
            mean = np.add.reduceat(x, starts, axis=0) / count[:, None]
            d = x - np.repeat(mean, count.astype(int), axis=0)
            within = np.add.reduceat(d[:, i] * d[:, j], starts, axis=0)
            slot = np.array([place.setdefault(name, len(place)) for name in named])
            if len(place) > len(n):
                grow = max(len(place), 2 * len(n)) - len(n)
                n, m, w = (np.concatenate([a, np.zeros((grow, *a.shape[1:]))]) for a in (n, m, w))
            both = n[slot] + count
            gap = mean - m[slot]
            w[slot] += within + gap[:, i] * gap[:, j] * (n[slot] * count / both)[:, None]
            m[slot] += gap * (count / both)[:, None]
            n[slot] = both
            if len(place) > held_keys:
                yield hand_on()
                n, m, w = n[:0], m[:0], w[:0]
        if place:
            yield hand_on()

    kept = rows.where(" AND ".join(f"`{c}` IS NOT NULL" for c in keys)).select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:k]) + ", n double, m array<double>, w array<double>"
    return kept.mapInArrow(run, schema)


def _merge(table: pa.Table) -> tuple[float, np.ndarray, np.ndarray]:
    return fold_all(table.column("n").to_numpy(), *(np.stack([np.frombuffer(x) for x in table.column(c).to_pylist()]) for c in ("m", "w")))


def _total(states: DataFrame, parts: int, k: int) -> tuple[float, np.ndarray, np.ndarray]:
    """One state from one per task, merged in stages; at most a fan-in of them reach the driver."""

    def merge(table: pa.Table) -> pa.Table:
        n, m, w = _merge(table)
        return pa.table([pa.array([0], pa.int64()), pa.array([n]), pa.array([m.tobytes()]), pa.array([w.tobytes()])], ["one", "n", "m", "w"])

    states = states.select(F.lit(0).cast("bigint").alias("one"), "part", "n", "m", "w")
    table = merge_in_stages(states, ["one"], parts, merge).toArrow().sort_by("part")
    return _merge(table) if table.num_rows else (0.0, np.zeros(k), np.zeros(len(pairs(k)[0])))


def moments(rows: DataFrame, cols: list[str]) -> tuple[float, np.ndarray, np.ndarray]:
    """The moments of all rows, in one pass: each task folds its rows batch by batch."""
    i, j = pairs(len(cols))

    def run(batches):
        from pyspark import TaskContext

        state = 0.0, np.zeros(len(cols)), np.zeros(len(i))
        for b in batches:
            if b.num_rows:
                x = _rows(b, 0)
                mean = x.mean(axis=0)
                d = x - mean
                state = fold_all(*(np.stack([np.asarray(a), np.asarray(b)]) for a, b in zip(state, (float(len(x)), mean, (d.T @ d)[i, j]))))
        yield _state_batch(TaskContext.get().partitionId(), [state])

    kept = rows.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return _total(kept.mapInArrow(run, "part bigint, n double, m binary, w binary"), task_count(kept), len(cols))


def moments_with_constants(parts: DataFrame, cols: int, constants: list[str]) -> tuple[float, np.ndarray, np.ndarray]:
    """The moments of the first ``cols`` columns and of ``constants``, which do not vary within a part, from written parts (n, m, w, constants)."""
    k = cols + len(constants)
    (i, j), (a, b) = pairs(k), pairs(cols)
    inside = np.searchsorted(i * k + j, a * k + b)  # where the pairs of the first columns stand among all

    def run(batches):
        from pyspark import TaskContext

        states = []
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column(0).to_numpy()
            m = np.concatenate([batch.column(1).flatten().to_numpy().reshape(len(n), cols), _rows(batch, 3)], axis=1)
            w = np.zeros((len(n), len(i)))
            w[:, inside] = batch.column(2).flatten().to_numpy().reshape(len(n), len(a))
            states.append(fold_all(n, m, w))
        if states:
            states = [fold_all(*(np.stack([np.asarray(s[c]) for s in states]) for c in range(3)))]
        yield _state_batch(TaskContext.get().partitionId(), states)

    kept = parts.select("n", "m", "w", *[F.col(c).cast("double").alias(c) for c in constants])
    return _total(kept.mapInArrow(run, "part bigint, n double, m binary, w binary"), task_count(parts), k)


def correlations(state: tuple[float, np.ndarray, np.ndarray], cols: list[str]) -> list[tuple]:
    """(col_a, col_b, r) of every pair; null where a column is constant."""
    _, _, w = state
    k = len(cols)
    c = np.zeros((k, k))
    c[pairs(k)] = w
    c = c + c.T - np.diag(np.diag(c))
    root = np.sqrt(np.diag(c))

    def r(i: int, j: int):
        if not (c[i, i] > 0 and c[j, j] > 0):
            return None
        return 1.0 if i == j else float(c[i, j] / (root[i] * root[j]))

    return [(a, b, r(i, j)) for i, a in enumerate(cols) for j, b in enumerate(cols)]
