"""Quantiles of many columns from mergeable summaries of fixed size.

A summary is a sorted list of values with the number of rows each stands for.
Up to ``CELLS`` distinct values it is exact. Beyond, neighbours are put
together into groups of at most 4 / CELLS of the rows, under their largest
value; a value that holds more keeps its own cell. Two summaries merge by
joining their lists. A shrink moves a quantile up by less than 4 / CELLS of
the rows it covers; a task merges summaries of like size only, so they shrink
log2(rows of the task / CELLS) times there and once a stage after it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope
from .staged_merge import merge_in_stages

CELLS = 1 << 14
# Rows of a task whose places are counted together.
PLACES_AT_ONCE = 1 << 20


def summary(values: np.ndarray, weights: np.ndarray | None = None, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and their weights (1 each without ``weights``), at most about ``cells`` of them."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    if weights is None:
        values = np.sort(values)
        upto = np.arange(1, len(values) + 1)
    else:
        order = np.argsort(values, kind="stable")
        values, upto = values[order], np.cumsum(weights[order])
    last = np.flatnonzero(np.concatenate([values[1:] != values[:-1], [True]]))
    weights = np.diff(np.concatenate([[0], upto[last]]))
    values = values[last]
    if len(values) > cells:
        upto = np.cumsum(weights)
        most = max(1, 4 * int(upto[-1]) // cells)
        group, heavy = (upto - 1) // most, weights > most
        last = np.flatnonzero(np.concatenate([(group[1:] != group[:-1]) | heavy[1:] | heavy[:-1], [True]]))
        values, weights = values[last], np.diff(np.concatenate([[0], upto[last]]))
    return values, weights


def merged(parts: list[tuple[np.ndarray, np.ndarray]], cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    return summary(np.concatenate([v for v, _ in parts]), np.concatenate([w for _, w in parts]), cells)


class Ladder:
    """Summaries of a stream: one at most of each size class, two of a class become one of the next."""

    def __init__(self, cells: int = CELLS):
        self.cells, self.steps, self.fresh, self.size = cells, [], [], 0

    def add(self, values: np.ndarray, weights: np.ndarray | None = None) -> None:
        if weights is not None:
            self._push(summary(values, weights, self.cells))
            return
        self.fresh.append(values)
        self.size += len(values)
        if self.size >= self.cells:
            self._climb()

    def _climb(self) -> None:
        values = np.concatenate(self.fresh)
        self.fresh, self.size = [], 0
        self._push(summary(values, None, self.cells))

    def _push(self, top: tuple[np.ndarray, np.ndarray]) -> None:
        for i, step in enumerate(self.steps):
            if step is None:
                self.steps[i] = top
                return
            top, self.steps[i] = merged([step, top], self.cells), None
        self.steps.append(top)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if self.fresh:
            self._climb()
        return merged([s for s in self.steps if s is not None] or [(np.zeros(0), np.zeros(0, np.int64))], self.cells)


def at_shares(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """The least value that k / bins of the rows do not exceed, for k = 1 .. bins - 1, each once."""
    if not len(values):
        return np.zeros(0)
    upto = np.cumsum(weights)
    at = np.searchsorted(bins * upto, np.arange(1, bins) * int(upto[-1]), "left")
    return np.unique(values[at])


def _state(s: tuple[np.ndarray, np.ndarray]) -> bytes:
    return s[0].astype("<f8").tobytes() + s[1].astype("<i8").tobytes()


def _from_state(state: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(state) // 2
    return np.frombuffer(state[:half], "<f8"), np.frombuffer(state[half:], "<i8")


def quantile_edges(df: DataFrame, columns: list[str], bins: int, cells: int = CELLS) -> list[np.ndarray]:
    """Up to ``bins - 1`` rising cut points of each column (double, no null or NaN), values of the data at equal ranks."""
    return edges_and_shares(df, columns, bins, cells=cells)[0]


def edges_and_shares(df: DataFrame, columns: list[str], bins: int, shared: str | None = None, cells: int = CELLS,
                     side: DataFrame | None = None, numbers: Callable[[pa.Array], np.ndarray] | None = None) -> tuple[list[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """``quantile_edges``, and the summary of the column ``shared``, from one pass over ``df``, which need not be written.

    Rows without a value of ``shared`` do not count; ``numbers`` makes numbers of its values. ``side`` (place, columns...)
    holds further columns, the same for all rows of a place, which ``df`` names
    in its column ``place``: places are counted in the pass, and a row of
    ``side`` stands for so many. Their edges follow those of ``columns``.
    """
    spark, aside = df.sparkSession, side is not None
    more = [c for c in side.columns if c != "place"] if aside else []
    k = len(columns) + len(more)
    names, schema = ["column", "part", "state", "place", "n"], "column int, part bigint, state binary, place bigint, n bigint"

    def states_of(ladders):
        from pyspark import TaskContext

        n, part = len(ladders), TaskContext.get().partitionId()
        return pa.record_batch([pa.array(list(ladders), pa.int32()), pa.array([part] * n, pa.int64()), pa.array([_state(x.result()) for x in ladders.values()]),
                                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)

    def counted(places):
        values, n = np.unique(np.concatenate(places), return_counts=True)
        m = len(values)
        return pa.record_batch([pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array(values, pa.int64()), pa.array(n, pa.int64())], names)

    def run(batches):
        ladders = {i: Ladder(cells) for i in [*range(len(columns)), *([] if shared is None else [k])]}
        places, waiting = [], 0
        for b in batches:
            if shared is not None:
                b = b.filter(b.column(len(columns)).is_valid())
            for (i, ladder), column in zip(ladders.items(), b.columns):
                ladder.add(column.to_numpy() if i < k or numbers is None else numbers(column))
            if aside:
                places.append(b.columns[-1].to_numpy())
                waiting += b.num_rows
                if waiting >= PLACES_AT_ONCE:
                    yield counted(places)
                    places, waiting = [], 0
        if places:
            yield counted(places)
        yield states_of(ladders)

    def run_side(batches):
        ladders = {len(columns) + i: Ladder(cells) for i in range(len(more))}
        for b in batches:
            for ladder, column in zip(ladders.values(), b.columns):
                ladder.add(column.to_numpy(), b.columns[-1].to_numpy())
        yield states_of(ladders)

    def merge(table: pa.Table) -> pa.Table:
        state = _state(merged([_from_state(s) for s in table.column("state").to_pylist()], cells))
        return pa.table([table.column("column").slice(0, 1), pa.array([state])], ["column", "state"])

    def cut(table: pa.Table) -> pa.Table:
        values, weights = merged([_from_state(s) for s in table.column("state").to_pylist()], cells)
        if table.column("column")[0].as_py() < k:
            values, weights = at_shares(values, weights, bins), np.zeros(0, np.int64)
        return pa.table([table.column("column").slice(0, 1), pa.array([values], pa.list_(pa.float64())), pa.array([weights], pa.list_(pa.int64()))],
                        ["column", "edges", "weights"])

    with scratch_scope(spark):
        # written, so that the number of tasks is known without planning or running ``df`` again
        found = materialize(df.select(*columns, *([] if shared is None else [shared]), *(["place"] if aside else [])).mapInArrow(run, schema))
        states = found.where("state IS NOT NULL").select("column", "part", "state")
        if aside:
            counts = found.where("place IS NOT NULL").groupBy("place").agg(F.sum("n").alias("n"))
            more_states = materialize(side.join(counts, "place").select(*more, "n").mapInArrow(run_side, schema))
            states = states.unionByName(more_states.select("column", "part", "state"))
        parts = max(spark.sparkContext.defaultParallelism, (states.agg(F.max("part")).first()[0] or 0) + 1)
        states = merge_in_stages(states, ["column"], parts, merge)
        found = {r.column: r for r in states.groupBy("column").applyInArrow(cut, "column int, edges array<double>, weights array<bigint>").collect()}
    edges = [np.array(found[i].edges if i in found else [], dtype=float) for i in range(k)]
    return edges, (np.array(found[k].edges if k in found else [], dtype=float), np.array(found[k].weights if k in found else [], dtype=np.int64))
