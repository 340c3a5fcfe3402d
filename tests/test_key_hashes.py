"""MD5s of many keys at once are the MD5s of any engine, and so are the buckets and copies drawn from them."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from farelane.operators import features as feat
from farelane.plans import key_hashes as kh
from farelane.plans import local_models as lm

ODD = ["", "0", "-5", "null", "é" * 20, "y" * 42, "y" * 43, "x" * 55, "x" * 56, "w" * 300]


def test_digests_are_those_of_hashlib(monkeypatch):
    keys = [str(k) for k in np.random.default_rng(0).integers(-10**12, 10**12, 500)] + ODD
    prefixes = ["bootstrap:3:", "bootstrap:4:", "bootstrap:12:", "bucket:", "", "p" * 54, "q" * 70]
    for at_once in (64, 1200, 1 << 15):
        monkeypatch.setattr(kh, "AT_ONCE", at_once)
        got = kh.KeyTexts(pa.array(keys)).md5(prefixes)
        for p, digests in zip(prefixes, got):
            for key, d in zip(keys, digests.T):
                assert d.astype(">u4").tobytes() == hashlib.md5((p + key).encode()).digest(), (p, key)
    assert (kh.KeyTexts(pa.array(keys).slice(7, 90)).md5(["a"]) == kh.KeyTexts(pa.array(keys)).md5(["a"])[:, :, 7:97]).all()
    assert kh.KeyTexts(pa.array([], pa.string())).md5(["a"]).shape == (1, 4, 0)


def test_buckets_and_copies_are_those_of_the_columns(spark):
    df = spark.range(3000).selectExpr("IF(id % 97 = 0, null, id * id * 31 - 5000) AS trip_id")
    rows = feat.with_bucket(df, 24).select(lm.key_text("trip_id").alias("text"), "bucket", lm.bootstrap_hashes("trip_id", 9).alias("h")).toPandas()
    texts = kh.KeyTexts(pa.array(rows.text))
    assert (texts.buckets(24) == rows.bucket.to_numpy()).all() and rows.bucket.nunique() == 24
    want = np.frombuffer(b"".join(rows.h), ">u4").reshape(len(rows), -1)[:, :9].T
    got = lm.bootstrap_bits(texts, 9)
    assert (got == want).all()
    assert (lm.poisson_weights(got) == np.searchsorted(lm.POISSON1, want / 2.0**32, "right")).all()
    edge = np.array([0, 2**32 - 1, *[s + d for s in map(int, lm.POISSON1_STEPS) for d in (-1, 0)]], np.uint32)
    assert (lm.poisson_weights(edge) == np.searchsorted(lm.POISSON1, edge / 2.0**32, "right")).all()


def test_buckets_drawn_in_tasks_give_the_same_forest(spark):
    df = spark.range(4000).select(F.col("id").alias("trip_id"), (F.col("id") * 37 % 101).cast("double").alias("a"), (F.col("id") % 13).alias("b"),
                                  (F.col("id") * 37 % 101 + F.col("id") % 13).cast("double").alias("y"))
    for depth in (0, 3):
        want = lm.fit_trees(feat.with_bucket(df, 3), ["a", "b"], "y", depth, 8, "bucket", 3, trees=0 if not depth else 2, key="trip_id")
        got = lm.fit_trees(df, ["a", "b"], "y", depth, 8, None, 3, trees=0 if not depth else 2, key="trip_id")
        assert (got.n == want.n).all() and (got.feature == want.feature).all() and (got.bin == want.bin).all()
        assert np.allclose(got.s, want.s) and (got.n[:, 1] > 0).all()
