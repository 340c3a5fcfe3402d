"""Operator 3 against a set of all windows."""

import hashlib
import random

import pytest
from tests.llm.helpers import clashing, empty, odd_documents, words

from farelane.llm import suffix_dedup as S


def _brute(rows):
    seen, out = set(), {}
    for k, (i, t) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                gone[p:p + 100] = b"\1" * 100
            else:
                seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.setdefault((i, len(b)), []).append((sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


def _rows(df):
    out = {}
    for r in S.remove_repeats(df).collect():
        out.setdefault((r.doc_id, r.n_bytes), []).append((r.n_removed, r.n_spans, r.kept_sha256))
    return {k: sorted(v) for k, v in out.items()}


def _passages(seed):
    rng = random.Random(seed)
    shared, rows = [words(rng, 60) for _ in range(5)], []
    for i in range(120):
        t = words(rng, rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) // 2)
            t += p[a:a + rng.randint(60, 300)] + words(rng, rng.randint(0, 15))
        rows.append((rng.choice([i, i, i, 7, None]), t))
    return rows + [(500, "x" * 1000), (501, "x" * 100), (502, "ab" * 300), (505, words(rng, 30) * 12), (506, shared[0]), (506, shared[0]), (None, shared[0])]


@pytest.mark.parametrize(("chunk", "slab", "range_", "kinds"), [(8 << 20, 1 << 17, 16 << 20, 4), (5000, 1000, 3000, 4), (3000, 700, 2000, 1)])
def test_equals_brute_force(spark, monkeypatch, chunk, slab, range_, kinds):
    """Whole, and with chunks, slabs and ranges so small that every bound is met."""
    for name, v in (("CHUNK_BYTES", chunk), ("SLAB", slab), ("RANGE_BYTES", range_), ("KINDS", kinds)):
        monkeypatch.setattr(S, name, v)
    df = spark.createDataFrame(_passages(chunk), "doc_id long, text string").coalesce(1)
    assert _rows(df) == _brute([(r.doc_id, r.text) for r in df.collect()])


def test_odd_rows_and_clashing_names(spark):
    df = odd_documents(spark).coalesce(1)
    assert _rows(clashing(df, ["chunk", "message", "kind", "range", "n_bytes"])) == _brute([(r.doc_id, r.text) for r in df.collect()])
    assert S.remove_repeats(empty(spark)).count() == 0


def test_a_hot_passage_with_many_neighbours(spark):
    """A passage that every document holds between texts of its own: all but the first lose it, and nothing else."""
    rng = random.Random(9)
    passage = words(rng, 80)
    df = spark.createDataFrame([(i, words(rng, 30) + passage + words(rng, 30)) for i in range(200)], "doc_id long, text string").repartition(5)
    rows = {r.doc_id: r for r in S.remove_repeats(df).collect()}
    assert rows[0].n_removed == 0 and all(rows[i].n_removed >= len(passage.encode()) and rows[i].n_spans == 1 for i in range(1, 200))
