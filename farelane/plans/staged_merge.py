"""Adding up partial states of many tasks in stages of bounded groups.

Tasks hand over rows (keys..., part, state): ``part`` is the task's number. A
stage puts the states of ``FAN_IN`` neighbouring parts of a key into one group
and merges them; stages repeat until a key has at most ``FAN_IN`` parts. So no
group grows with the number of tasks, and the number of stages only with its
logarithm. Sums are taken in the order of parts, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 64


def task_count(df: DataFrame) -> int:
    """Tasks that read a written table: the bound of their numbers."""
    return df.rdd.getNumPartitions()


def merge_in_stages(states: DataFrame, keys: list[str], parts: int, merge: Callable[[pa.Table], pa.Table], fan_in: int = FAN_IN) -> DataFrame:
    """The states with at most ``fan_in`` parts a key. ``merge`` gets a group's rows sorted by part and returns rows without ``part``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        part = table.column("part")[0].as_py() // fan_in
        out = merge(table.drop_columns(["part"]))
        return out.append_column("part", pa.array([part] * out.num_rows, pa.int64())).select(names)

    names, schema = states.columns, ", ".join(f"{c} {t}" for c, t in states.dtypes)
    while parts > fan_in:
        states = states.groupBy(*keys, F.expr(f"part div {fan_in}")).applyInArrow(run, schema)
        parts = -(-parts // fan_in)
    return states
