"""Operator 10 against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from tests.llm.helpers import clashing, empty, odd_documents, words

from farelane.llm import simhash_golay as G
from farelane.llm.components import components


def _fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(shingles))


def _brute(rows):
    fps = [_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((str(rows[i][0]), f"{fps[i]:016x}", least.get(find(i))) for i in range(len(rows))), key=str)


def _rows(df):
    return sorted(((str(r.doc_id), f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in G.near_duplicates(G.fingerprints(df)).collect()), key=str)


def test_equals_all_pairs(spark):
    rng = random.Random(2)
    seeds = [words(rng, 150) for _ in range(12)]
    rows = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    for i in range(160):  # copies with some words changed
        w = rng.choice(seeds).split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "q" * rng.randint(1, 5)
        rows.append((1000 + i, " ".join(w).upper() if i % 2 else "\t".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = _brute(rows)
    assert _rows(clashing(df, ["fp", "key", "root", "component_id"])) == want
    assert len({c for _, _, c in want}) < len(rows) - 20  # links there are


def test_keys_meet_whenever_two_bits_differ_at_most():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 300).astype(np.uint64)
    code = G.golay_table()
    for a in range(0, 65, 3):
        y = x.copy()
        for b in {a, int(rng.integers(0, 64))} - {64}:
            y ^= np.uint64(1 << b)
        kx, ky = G.fuzzy_keys(x, code), G.fuzzy_keys(y, code)
        for i in range(len(x)):
            assert set(kx[1][kx[0] == i].tolist()) & set(ky[1][ky[0] == i].tolist())
    assert np.bincount(code).tolist() == [2048] * 4096  # the code is perfect


def test_long_texts_in_blocks(monkeypatch):
    rng = random.Random(4)
    text = words(rng, 2000) + "  \n\t" + words(rng, 3)
    want = _fingerprint(text)
    for block in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(G, "BLOCK", block)
        assert G.fingerprint(text.encode()) == want
    assert G.fingerprint(b"") == 0 and G.fingerprint(b"one two") == xxhash.xxh64_intdigest(b"one two", 42)


def test_keep_one_of_each_group(spark):
    df = clashing(odd_documents(spark), ["fp", "keep_id", "row", "root"])
    kept = G.keep_one(df)
    assert kept.columns == df.columns
    groups = {c for _, _, c in _rows(df)}
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(g) for g in groups)
    assert G.keep_one(empty(spark)).count() == 0 and G.near_duplicates(G.fingerprints(empty(spark))).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, j) for j in range(1001, 1300)] + [(5000, 5000), (7, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1300)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_without_ids_keep_one(spark, monkeypatch):
    fp = {"a": 0b111, "b": 0b101, "c": 0b001, "d": 0xFFFF0000}
    df = spark.createDataFrame([(None, t) for t in "abcda"], "doc_id long, text string")
    prints = spark.createDataFrame([(None, t, fp[t]) for t in "abcda"], "doc_id long, text string, fp long")
    monkeypatch.setattr(G, "fingerprints", lambda *_: prints.selectExpr("doc_id", "xxhash64(text) AS text_hash", "fp"))
    kept = sorted(r.text for r in G.keep_one(df).collect())
    assert len(kept) == 2 and kept[0] in "abc" and kept[1] == "d"


def _brute_components(fps):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("max_group", [1, 2, 5, G.MAX_GROUP])
def test_links_are_the_same_however_few_are_paired(spark, max_group):
    """Crowded neighbourhoods, chains and strangers: pairs from the Golay join and meetings in neighbouring words give one result."""
    rng = np.random.default_rng(7)
    fps = set()
    for _ in range(6):
        centre = int(rng.integers(-2**63, 2**63))
        for _ in range(40):
            f = centre
            for b in rng.choice(64, rng.integers(0, 4), replace=False):
                f ^= 1 << int(b)
            fps.add((f + 2**63) % 2**64 - 2**63)
    fps |= {int(x) for x in rng.integers(-2**63, 2**63, 200)}
    df = spark.createDataFrame([(f,) for f in sorted(fps)], "fp bigint").repartition(5)
    want = _brute_components(sorted(fps))
    got = {r.node: r.root for r in G.link(df, max_group).collect()}
    assert got == {f: r for f, r in want.items() if sum(x == r for x in want.values()) > 1}
