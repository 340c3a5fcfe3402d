import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from farelane.llm import filter_audit as A
from tests.llm.helpers import clashing, empty, odd_documents, words

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels, min_words):
    """By the definition, one document, order and step at a time."""
    docs = [(i, t or "", p or "") for i, t, p in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = []
    for i, t, _ in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({c for c, f in zip("ABCDE", (
            len(w) < min_words, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)),
            i is not None and any(j is not None and j < i and u == t for j, u, _ in docs))) if f})
    out = set()
    for part in {p for _, _, p in docs}:
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        own = [(i, f) for (i, _, p), f in zip(docs, fails) if p == part]
        for order in permutations("ABCDE"):
            here = own
            for step, f in enumerate(order, 1):
                lost = [x for x in here if f in x[1]]
                here = [x for x in here if f not in x[1]]
                shapley[f] += len(lost)
                rows.append((part, "".join(order), step, len(here), len(lost), sum(f in x[1] for x in own) - len(lost), sum(x[1] == {f} for x in own),
                             sum(x[0] in good for x in lost), sum(x[0] in toxic for x in lost), f))
        out |= {(*r[:-1], shapley[r[-1]]) for r in rows}
    return out


@pytest.fixture(scope="module")
def cases(spark):
    docs = odd_documents(spark).select("doc_id", "text", "lang").collect()
    rows = [tuple(r) for r in docs]
    rows += [(200 + i, t, l) for i, (t, l) in enumerate([
        ("A B C", "de"), ("A B C", "en"), ("a b # c", "de"), ("é" * 97 + "ABC", None), ("é" * 96 + "ABCD", ""), ("same " * 9, "de"), ("x y", "de"), ("A B C", "de")])]
    rows += [(300, "A B C", "de"), (300, "A B C", "de"), (None, "A B C", "de"), (None, "A B C", "en"), (301, words(random.Random(2), 250, "ABCabc"), "de")]
    labels = [(0, 1, 0), (1, 0, 1), (200, 1, 1), (201, None, 1), (202, 1, None), (300, 0, 0), (300, 1, 0), (None, 1, 1), (999, 1, 1), (205, 1, 0), (106, 0, 1)]
    return rows, labels


def frames(spark, cases):
    rows, labels = cases
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize("shard_bytes,min_words", [(1, 20), (500, 3), (A.SHARD_BYTES, 200)])
def test_equals_brute_force(spark, cases, shard_bytes, min_words):
    got = A.interactions(*frames(spark, cases), shard_bytes=shard_bytes, min_words=min_words).collect()
    assert len(got) == 600 * len({r.part for r in got})
    assert {tuple(r) for r in got} == brute(*cases, min_words)


def test_matrix_is_the_words_of_the_texts(spark, cases):
    docs, _ = frames(spark, cases)
    shards = A.keep(A.local_shards(docs, shard_bytes=300))
    numbers = A.numbered(shards)
    listed = A.dictionary(numbers).collect()
    term = {r.id: bytes(r.word).decode() for r in listed}
    assert len(set(term.values())) == len(term) == len(listed) > 100
    got = []
    for s in A.csr_shards(shards, numbers).collect():
        for i, d in enumerate(s.doc_id):
            at = slice(s.starts[i], s.starts[i + 1])
            got.append((d, sorted((term[k], n) for k, n in zip(s.terms[at], s.n[at]))))
    want = []
    for i, t, _ in cases[0]:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want.append((i, sorted((x, w.count(x)) for x in set(w))))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_shards_are_bounded_and_numbers_unique(spark, cases):
    docs, _ = frames(spark, cases)
    with_rows = A.local_shards(docs, shard_bytes=64).select("shard", F.size("doc_id").alias("n")).collect()
    assert sum(r.n for r in with_rows) == len(cases[0]) and len({r.shard for r in with_rows}) == len(with_rows) > 20


def test_one_row_a_batch(spark, cases):
    """Numbers of shards do not collide, however many a task makes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 7).alias("text"), F.lit("en").alias("lang")).coalesce(2)
        got = A.interactions(docs, frames(spark, cases)[1], min_words=1).where("filter_order = 'EABCD' AND step = 1").first()
        assert (got.kept, got.removed) == (7, 8993)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_tables_and_clashing_columns(spark, cases):
    docs, labels = frames(spark, cases)
    assert A.interactions(empty(spark), labels).count() == 0
    names = ["part", "mask", "digest", "words", "first", "n", "shard", "quality", "toxic", "step", "s"]
    got = A.interactions(clashing(docs, names), clashing(labels, ["part", "text", "lang", "n", "digest"]))
    assert {tuple(r) for r in got.collect()} == brute(*cases, 200)
    none = A.interactions(docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(none) == (0, 0)
