"""What a level of trees counts: each row of a smaller child once, by pairs of own features and by whole contexts."""

import numpy as np
import zstandard
from pyspark.sql import functions as F

from farelane.plans import local_models as lm
from farelane.plans import staged_merge as sm


def test_of_two_siblings_the_smaller_is_counted(spark, monkeypatch):
    counted, n_bins = [], 8

    def watched(states, keys, parts, merge):
        if "slot" in states.columns:
            rows = states.select("histogram").collect()
            counted.append(sum(np.frombuffer(zstandard.decompress(r.histogram)).reshape(2, 2, -1)[0, 0].sum() for r in rows))
        return sm.merge_in_stages(states, keys, parts, merge)

    monkeypatch.setattr(lm, "merge_in_stages", watched)
    df = spark.range(9000).select(F.col("id").alias("trip_id"), (F.col("id") % 2).cast("int").alias("bucket"), (F.col("id") * 37 % 101).cast("double").alias("a"),
                                  (F.col("id") * 13 % 17).cast("double").alias("b"))
    df = df.withColumn("y", F.col("a") * F.col("a") + F.col("b"))
    models = lm.fit_trees(df, ["a", "b"], "y", 4, n_bins, "bucket", 2)
    assert counted[0] == 9000 and len(counted) == 4
    for level in range(1, 4):
        parents = [(g, node) for g in range(2) for node in range(1 << level - 1, 1 << level) if models.feature[g, node] >= 0]
        assert len(parents) > 1
        assert counted[level] == sum(min(models.n[g, 2 * p], models.n[g, 2 * p + 1]) for g, p in parents) <= 4500
        for g, p in parents:
            assert models.n[g, 2 * p] + models.n[g, 2 * p + 1] == models.n[g, p]
            assert np.isclose(models.s[g, 2 * p] + models.s[g, 2 * p + 1], models.s[g, p])
    # and what is told of a node taken from its parent is what its rows give
    rows = df.toPandas()
    for g in range(2):
        own = rows[rows.bucket == g]
        bins = lm._binned([own.a.to_numpy(), own.b.to_numpy()], models.edges)
        node = lm._walk(bins, np.full(len(own), g), models.feature, models.bin, 3)
        for k in np.unique(node):
            assert models.n[g, k] == (node == k).sum() and np.isclose(models.s[g, k], own.y[node == k].sum())


def test_features_of_one_context_are_counted_together():
    rng = np.random.default_rng(0)
    table = np.stack([rng.integers(0, 32, 900) for _ in range(20)], axis=1).astype(np.uint8)
    features, widths = list(range(20)), [32] * 20
    sums = rng.integers(0, 9, (6, 900)).astype(float)
    want = np.stack([[np.bincount(table[:, f], s, 32) for f in features] for s in sums])
    assert len(lm._joint(widths, 1024)) == 10
    for most, sets in ((900, 1), (100, 20)):
        found = lm._context_sets(table, features, widths, most)
        assert len(found) == sets and sorted(f for own, _, _ in found for f in own) == features
        for own, number, cells in found:
            by_cell = np.stack([np.bincount(number, s, len(cells)) for s in sums])
            assert (lm._folded(by_cell, cells, [widths[f] for f in own]).reshape(6, len(own), 32) == want[:, own]).all()
    # features that follow from few combinations go together even where the contexts are many
    hours = np.stack([np.arange(900) // 30 % 30, np.arange(900) // 60 % 15, np.arange(900) % 30], axis=1).astype(np.uint8)
    assert [own for own, _, _ in lm._context_sets(hours, [4, 5, 6], [32] * 7, 40)] == [[4, 5], [6]]


def test_many_contexts_of_many_blocks_keep_their_numbers(monkeypatch):
    """Numbers of two bytes in a block become numbers over all blocks of a group, of which there are more than 65,536."""
    rng, blocks, bins, contexts, copies, y = np.random.default_rng(0), [], [], [], [], []
    for _ in range(5):
        own, table = rng.integers(0, 9, (2, 20_000)).astype(np.uint8), rng.integers(0, 200, (20_000, 3)).astype(np.uint8)
        number, c, label = rng.permutation(20_000), rng.integers(0, 5, (4, 20_000)).astype(np.uint8), rng.random(20_000)
        data = (20_000).to_bytes(4, "little") + table.tobytes() + lm._planes(number.astype("<u2")) + own.tobytes() + c.tobytes() + lm._planes(label)
        blocks.append((20_000, zstandard.compress(data, 1)))
        for kept, x in zip((bins, contexts, copies, y), (own, table[number], c, label)):
            kept.append(x)
    got, copy, label, table, number = lm._unpacked(blocks, 2, 3, 4, False)
    assert (table[number] == np.concatenate(contexts)).all() and len(np.unique(table, axis=0)) == len(table)
    assert (got == np.concatenate(bins, axis=1)).all() and (copy == np.concatenate(copies, axis=1)).all() and (label == np.concatenate(y)).all()


def test_rows_counted_in_pieces_make_the_same_forest(spark, monkeypatch):
    df = spark.range(5000).select(F.col("id").alias("trip_id"), F.lit(0).alias("bucket"), (F.col("id") * 37 % 101).cast("double").alias("a"),
                                  (F.col("id") * 13 % 17).cast("double").alias("b"), (F.col("id") % 24).alias("hour"))
    df = df.withColumn("y", F.col("a") * F.col("b") + F.col("hour"))
    context = spark.range(24).selectExpr("id AS hour", "double(id % 6) AS c", "double(id * id % 7) AS d")

    def fit():
        return lm.fit_trees(df, ["c", "a", "d", "b"], "y", 4, 16, "bucket", 1, trees=3, key="trip_id", context=context, keys=("hour",))

    want = fit()
    for name, value in (("PIECE_ROWS", 100), ("JOINT_CELLS", 1), ("CONTEXT_CELLS", 1), ("FOLD_BYTES", 1), ("FOLD_ROWS", 5), ("HELD_BYTES", 1), ("CHUNK_BYTES", 40_000),
                        ("ROWS_A_BLOCK", 300), ("ROWS_A_TASK", 700)):
        monkeypatch.setattr(lm, name, value)
    got = fit()
    assert (want.feature >= 0).sum() > 10 and (got.feature == want.feature).all() and (got.bin == want.bin).all() and (got.n == want.n).all()
    assert np.allclose(got.s, want.s) and np.allclose(got.gain, want.gain)
