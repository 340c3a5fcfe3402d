"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.session import materialize


def _signature(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) edges: root is the smallest node of its component.

    Each round writes its edges under the checkpoint folder. A large star
    hangs a node's larger neighbours on its smallest one, a small star the
    smaller ones and the node; the edges of a node are only aggregated and
    joined, never gathered into one row. A frame without edges gives no rows.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = _signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = _signature(edges)
        if now == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        last = now
