"""Fitted Spark ML tree models as tables of nodes, and scoring by walking them.

A model is saved under the shared folder and its node rows read back; they are
numbered as a heap (root 1, children 2n and 2n + 1). Boosted trees carry their
weight. A model has at most trees x 2^(depth + 1) nodes, a bound set by
parameters, so the rows pass through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .local_models import TreeModels, score_tree_ensemble

NODE_SCHEMA = ("tree int, weight double, node bigint, level int, n double, s double, value double, feature_name string, "
               "threshold double, gain double")


@dataclass
class NodeTable:
    """Nodes of a fitted model's trees, in the columns of ``NODE_SCHEMA``."""

    rows: list[tuple]
    features: list[str]

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rows, NODE_SCHEMA)

    @property
    def trees(self) -> int:
        return len({r[0] for r in self.rows})

    def arrays(self, trees: int | None = None) -> tuple[TreeModels, np.ndarray]:
        """The first ``trees`` trees (all by default) as arrays that rows can be walked through, and their weights."""
        rows = [r for r in self.rows if trees is None or r[0] < trees]
        edges = [np.array(sorted({r[8] for r in rows if r[7] == f})) for f in self.features]
        groups, depth = sorted({r[0] for r in rows}), max(r[3] for r in rows)
        models, weights = TreeModels(groups, self.features, edges, depth, "tree"), np.zeros(len(groups))
        for tree, weight, node, _, n, s, _, name, threshold, gain in rows:
            models.n[tree, node], models.s[tree, node], weights[tree] = n, s, weight
            if name is not None:
                f = self.features.index(name)
                models.feature[tree, node], models.bin[tree, node], models.gain[tree, node] = f, int(np.searchsorted(edges[f], threshold)), gain
        return models, weights

    def score(self, df: DataFrame, out: str = "prediction", trees: int | None = None) -> DataFrame:
        """Weighted sum of the first trees' values for each row (for one tree its value); null where a feature is missing."""
        models, weights = self.arrays(trees)
        return score_tree_ensemble(models, df, out, weights=weights)


def node_table(model: Model, features: list[str]) -> NodeTable:
    """The nodes of a fitted decision tree or boosted trees on the assembled ``features``."""
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    path = scratch_path(spark, "model")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        saved = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
        weights = list(model.treeWeights)
    else:
        saved, weights = saved.withColumn("tree", F.lit(0)), [1.0]
    known = {(r.tree, r.id): r for r in saved.collect()}
    rows, open_ = [], [(t, 0, 1) for t in range(len(weights))]
    while open_:
        tree, i, node = open_.pop()
        r = known[tree, i]
        n, s = r.impurityStats[0], r.impurityStats[1]
        inner = r.leftChild >= 0
        rows.append((tree, float(weights[tree]), node, node.bit_length() - 1, n, s, r.prediction, features[r.split.featureIndex] if inner else None,
                     r.split.leftCategoriesOrThreshold[0] if inner else None, r.gain * n if inner else None))
        if inner:
            open_ += [(tree, r.leftChild, 2 * node), (tree, r.rightChild, 2 * node + 1)]
    return NodeTable(sorted(rows, key=lambda r: (r[0], r[2])), list(features))
