"""Operator 2: base columns against brute force; the model against its own promises."""

import math
import zlib
from collections import Counter

from pyspark.sql import functions as F
from tests.llm.helpers import clashing, empty, odd_documents

from farelane.llm import context_mixing as C


def _tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def _brute(rows):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    train = Counter(w for i, t in rows if not held(i) for w in _tokens(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        w = _tokens(t)
        out.append((str(i), held(i), len(w), sum(train[x] > 0 for x in w), n, round(sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)))
    return sorted(out)


def _rows(df):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


def test_base_columns_equal_brute_force(spark, monkeypatch):
    df = odd_documents(spark)
    monkeypatch.setattr(C, "CHUNK_BYTES", 2000)  # several chunks, of slices
    out = C.score_documents(clashing(df, ["word", "k", "n", "chunk", "score", "held_out"])).cache()
    assert _rows(out) == _brute([(r.doc_id, r.text) for r in df.collect()])
    for r in out.collect():
        assert r.score < 0 and math.isfinite(r.score) and r.bits_per_byte >= 0


def test_held_out_texts_teach_nothing_and_the_model_beats_the_base(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a = {r.doc_id: r for r in C.score_documents(docs).collect()}
    held = [i for i, r in a.items() if r.held_out]
    assert sum(r.score for r in a.values()) > sum(r.base_score for r in a.values())
    changed = docs.withColumn("text", F.when(F.col("doc_id") == held[0], F.lit("other text altogether")).otherwise(F.col("text")))
    b = {r.doc_id: r for r in C.score_documents(changed).collect()}
    same = [i for i in a if i != held[0]]
    assert all(abs(a[i].score - b[i].score) < 1e-6 * abs(a[i].score) for i in same)


def test_probabilities_of_all_next_bytes_sum_to_one(spark):
    """The bit predictors give a distribution: over all bytes after a prefix it sums to one."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(0)
    tables = [rng.integers(0, 50, (2, 1 << bits)).astype(np.float32) for _, _, bits in C.PREDICTORS]
    ready = [(C._logits(*t), C._steps(t.sum(axis=0))) for t in tables]
    weights = rng.normal(0.3, 0.1, (C.GATES, len(C.PREDICTORS) + 1))
    s = C.symbols(pa.array(["1ab"]))
    at, total = 2, 0.0  # the symbol after "ab"
    s.contexts = [np.repeat(c[at], 256) for c in s.contexts]
    s.value = np.arange(256, dtype=np.uint32)
    p = np.ones(256)
    for bit in range(8):
        x, gate = C._inputs(s, bit, tables, None, ready)
        z = sum(x[k] * weights[gate, k] for k in range(len(x)))
        p *= 1 / (1 + np.exp(-np.where(s.bit(bit), z, -z)))
    total = p.sum()
    assert abs(total - 1) < 1e-9


def test_empty_table(spark):
    assert C.score_documents(empty(spark)).count() == 0


def test_no_training_texts(spark):
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1]
    df = spark.createDataFrame([(i, "a b c") for i in held], "doc_id long, text string")
    rows = C.score_documents(df).collect()
    assert len(rows) == len(held) and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in rows)


def test_a_long_unseen_word_costs_its_full_spelling(spark):
    import random

    rng = random.Random(3)
    held = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 1)
    junk = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(50_000))
    rows = [(i, "some ordinary words of a text") for i in range(50)] + [(held, junk)]
    r = C.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).where(f"doc_id = {held}").first()
    assert r.held_out and r.n_known == 1
    assert r.bits_per_byte > 5  # log2(38) for random characters; a floor of 1e-300 for the word made it 0.02


def test_a_word_is_predicted_from_the_word_before_it(spark):
    """The same words in another order score worse, and counts of pairs are those of the other training texts."""
    import random

    rng = random.Random(4)
    names = [f"w{k}" for k in range(40)]
    follows = dict(zip(names, rng.sample(names, 40), strict=True))

    def text(n=60):
        out = [rng.choice(names)]
        while len(out) < n:
            out.append(follows[out[-1]] if rng.random() < 0.9 else rng.choice(names))
        return out

    held = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    some = text()
    shuffled = rng.sample(some, len(some))
    rows = [(i, " ".join(text())) for i in range(200) if i not in held] + [(held[0], " ".join(some)), (held[1], " ".join(shuffled))]
    r = {x.doc_id: x for x in C.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert r[held[0]].score > r[held[1]].score + 20


def test_counts_of_pairs_equal_brute_force(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(C, "PAIRS_A_RANGE", 500)
    docs = C.folded(odd_documents(spark))
    parts = C.chunks(docs, C.fit_classes(docs), 2000).cache()
    payloads = parts.where("payload IS NOT NULL").select("chunk", "payload")
    tokens = parts.where("payload IS NOT NULL").agg(F.sum("n")).first()[0]
    got = {}
    for r in C.pair_counts(payloads, tokens).orderBy("chunk", "part").collect():
        got.setdefault(r.chunk, []).append(C._unpack(bytes(r.payload), 1)[0])
    every = Counter()
    for r in docs.collect():
        if not r.held_out:
            w = [b"\n", *_tokens(r.text)]
            every.update(zip(w, w[1:]))
    entries = {(r.chunk, r.k): r.entry[1:].encode() for r in parts.where("payload IS NULL").collect()}
    for r in payloads.collect():
        _, words, hashes = C._read_payload(bytes(r.payload))
        keys = C._pair_keys(words, hashes)
        found = np.concatenate(got[r.chunk])[np.searchsorted(np.unique(keys), keys)]
        named = [entries[r.chunk, int(k)] for k in words]
        assert found.tolist() == [every[named[i - 1], named[i]] for i in range(len(named))]


def test_no_row_is_lost_with_a_batch_a_row(spark):
    """9,000 batches in two tasks: chunks keep numbers of their own, and every document its row and its base values."""
    rows = [(i, f"w{i % 13} w{i % 7} x") for i in range(9000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        out = C.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
        assert _rows(out) == _brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_chunks_are_whole_and_more_than_their_numbers_fail(spark, monkeypatch):
    import pytest

    docs = C.folded(odd_documents(spark)).repartition(2)
    centres = C.fit_classes(docs)
    one = {r.chunk: r.n for r in C.chunks(docs, centres).where("payload IS NOT NULL").collect()}
    many = {r.chunk: r.n for r in C.chunks(docs, centres, 300).where("payload IS NOT NULL").collect()}
    assert len(one) <= 2 < 20 < len(many) and sum(one.values()) == sum(many.values())
    monkeypatch.setattr(C, "CHUNK_BITS", 2)
    with pytest.raises(Exception, match="use more, smaller partitions"):
        C.chunks(docs, centres, 300).count()


def test_sample_of_profiles_is_bounded_under_a_hot_id(spark, monkeypatch):
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1]
    hot = next(i for i in range(50) if i not in held)
    rows = [(hot, f"text number {i} " + "abc"[i % 3] * (i % 29)) for i in range(3000)]
    docs = C.folded(spark.createDataFrame(rows, "doc_id long, text string"))
    seen = []
    nearest = C.nearest
    monkeypatch.setattr(C, "nearest", lambda x, c: seen.append(len(x)) or nearest(x, c))
    C.fit_classes(docs, sample_docs=100)
    assert 20 < seen[0] <= 200


def test_classes_are_learned_from_every_training_text(spark):
    """Centres are the means of all training texts nearest to them, repeats included, and reruns agree."""
    import numpy as np
    import pyarrow as pa

    kinds = ("abcdefg", "hijklmno", "0123456789")
    rows = [(i, " ".join(kinds[2 if i % 1000 == 7 else i % 2][(i * k) % 7:][:1 + (i + k) % 5] for k in range(1, 30))) for i in range(6000)]
    df = spark.createDataFrame(rows + rows[:500], "doc_id long, text string").repartition(5)
    docs = C.folded(df)
    centres = C.fit_classes(docs, classes=3)
    x = C.byte_profiles(pa.array([r.text for r in docs.where("NOT held_out").collect()]))
    of = C.nearest(x, centres)
    assert np.bincount(of, minlength=3).min() > 0 and len(centres) == 3
    assert np.allclose(centres, [x[of == k].mean(axis=0) for k in range(3)], atol=1e-5)
    assert np.allclose(centres, C.fit_classes(C.folded(df.repartition(3)), classes=3), atol=1e-5)
    assert C.fit_classes(docs.where("held_out")).tolist() == np.zeros((1, 256)).tolist()
    assert len(C.fit_classes(docs.limit(0).union(spark.createDataFrame([(1, False, "same")] * 9, docs.schema)))) == 1


def test_bits_are_counted_in_little_memory():
    """Counts equal a plain loop, and no copy of all bits of a batch is made: with one, two tasks passed an executor's limit."""
    import random
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = random.Random(6)
    entries = [f"{rng.randrange(8)}" + rng.choice(["\n", "", "é"] + ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 30)))] * 9) for _ in range(20_000)]
    n = np.array([rng.randrange(5) for _ in entries])
    s = C.symbols(pa.array(["skipped", *entries]).slice(1))
    data = [(e[1:] if e[1:] == "\n" else e[1:] + " ").encode() for e in entries]
    assert bytes(s.value.astype(np.uint8)) == b"".join(data) and np.bincount(s.word).tolist() == [len(d) for d in data]
    tables = [np.zeros((2, 1 << bits)) for _, _, bits in C.PREDICTORS]
    tracemalloc.start()
    C.count_bits(tables, s, n)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(s.value)  # a copy of all bits alone is 64
    for p in (0, 4):
        want = Counter()
        for bit in range(8):
            for slot, one, w in zip(s.slots(p, s.nodes(bit)).tolist(), s.bit(bit).tolist(), n[s.word].tolist(), strict=True):
                want[int(one), slot] += w
        assert {(a, b): tables[p][a, b] for a, b in zip(*map(np.ndarray.tolist, np.nonzero(tables[p])), strict=True)} == {k: v for k, v in want.items() if v}
