"""Operator 6 against a plain statement of the mix."""

import re
from collections import defaultdict

from pyspark.sql import functions as F
from tests.llm.helpers import SCHEMA, clashing, empty, odd_documents, rows_of

from farelane.llm import source_mix as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    done, left = {}, float(sum(sizes.values()))
    while True:  # the excess is reshared by weight until none is above
        free = [s for s in names if s not in done]
        share = left / max(sum(w[s] for s in free), 1)
        over = [s for s in free if share * w[s] > cap * sizes[s]]
        if not over:
            return done | {s: share * w[s] for s in free}
        for s in over:
            done[s] = cap * sizes[s]
            left -= done[s]


def _check(df, rows, **kw):
    size = defaultdict(int)
    for r in rows:
        size[r.source] += len(WORD.findall(r.text or ""))
    target = _targets(size)
    taken = defaultdict(int)
    for r in M.mix_sources(M.sized_documents(df), **kw).collect():
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in size)


def test_targets_are_met_to_the_word(spark):
    df = odd_documents(spark)
    _check(clashing(df, ["size", "taken", "target", "mix_key", "row"]), df.collect())
    _check(df, df.collect(), rows_a_bucket=5)  # cuts inside one of many buckets


def test_reruns_agree_and_hot_source(spark):
    df = odd_documents(spark)
    sized = lambda d: M.sized_documents(d)
    assert rows_of(M.mix_sources(sized(df))) == rows_of(M.mix_sources(sized(df.repartition(9))))
    rows = [(i, "w " * (i % 7 + 1), "en", "hot" if i % 3 else f"s{i % 5}", 0) for i in range(3000)]
    _check(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA).collect(), rows_a_bucket=64)


def test_one_id_spreads_over_buckets_and_reruns_agree(spark):
    """Documents that share an id, or have none, are cut alike in every run and fall into all buckets."""
    rows = [(None if i % 2 else 7, f"text {i} " + "w " * (i % 5), "en", "hot" if i % 3 else "b", 0) for i in range(1200)]
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = (rows_of(M.mix_sources(M.sized_documents(d), rows_a_bucket=64)) for d in (df, df.orderBy(F.rand(3)).repartition(11)))
    assert a == b
    assert rows_of(M.mixed_documents(df)) == rows_of(M.mixed_documents(df.orderBy(F.rand(4)).repartition(7)))
    key = F.substring(F.md5(F.concat(F.lit("mix-1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5("text"))), 1, 1)
    assert df.select(key).distinct().count() == 16
    _check(df, df.collect(), rows_a_bucket=64)


def test_empty_tables_and_sources_without_words(spark):
    assert M.mix_sources(M.sized_documents(empty(spark))).count() == 0
    rows = M.mix_sources(M.sized_documents(spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], SCHEMA))).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_mixed_documents_hold_the_words_taken(spark):
    df = clashing(odd_documents(spark), ["size", "row", "words", "over"])
    out = M.mixed_documents(df)
    assert out.columns == df.columns and out.schema == df.schema or [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    mixed, kept = defaultdict(int), defaultdict(int)
    for r in M.mix_sources(M.sized_documents(df)).collect():
        mixed[r.source] += r.taken
    texts = {r.text for r in df.collect()}
    cut = 0
    for r in out.collect():
        kept[r.source] += len(WORD.findall(r.text or ""))
        cut += r.text not in texts
    assert {s: n for s, n in kept.items() if n} == {s: n for s, n in mixed.items() if n} and cut <= len(mixed)
    assert M.mixed_documents(empty(spark)).count() == 0
