import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm import language_filters as L
from farelane.llm.common import table
from tests.llm.helpers import clashing, empty, odd_documents

SHARE = 1e-3


def plain_grams(text, orders=L.ORDERS):
    """Letter n-grams inside padded words, one at a time."""
    out = []
    for w in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        w = f" {w} "
        out += [w[i:i + n] for n in orders for i in range(len(w) - n + 1)]
    return out


def brute(rows, share=SHARE):
    """(doc_id, held_out, lang_pred, score) with whole sets in place of filters."""
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 3 == 1
    counts = {}
    for i, text, lang in rows:
        if not held(i) and lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    counts = {k: c for k, c in counts.items() if c}
    order = sorted(counts, key=lambda k: (-sum(counts[k].values()), k))
    kept = {k: {g for g, n in counts[k].items() if n >= share * sum(counts[k].values())} for k in order}
    out = []
    for i, text, _ in rows:
        grams = plain_grams(text or "")
        hits = [sum(g in kept[k] for g in grams) for k in order]
        best = int(np.argmax(hits)) if hits else 0
        out.append((i, held(i), order[best], hits[best] / len(grams)) if grams and hits else (i, held(i), "und", 0.0))
    return out


def rows_of(docs):
    return [(r.doc_id, r.text, r.lang) for r in docs.collect()]


def judged(docs, share=SHARE, **kw):
    return [tuple(r) for r in L.identify(L.folds(docs), share, **kw).collect()]


def same(got, want):
    """Equal but for the filters' false positives, which the correction takes off on average."""
    got, want = sorted(got, key=str), sorted(want, key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    np.testing.assert_allclose([g[3] for g in got], [w[3] for w in want], atol=2e-3)


def test_equals_whole_sets(spark, sf):
    docs = table(spark, sf, "documents").where("length(text) < 5000")
    same(judged(docs.repartition(6)), brute(rows_of(docs)))


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = L.identify(L.folds(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 250 and right >= 0.99


def test_odd_documents(spark):
    docs = odd_documents(spark).unionByName(spark.createDataFrame(
        [(400 + i, t, lang, None, 0) for i, (t, lang) in enumerate([
            ("123 !? ··", "en"), ("x", "fr"), ("ΣΑΣ σας", "el"), ("İstanbul İ", "tr"), ("漢字かな 漢字", "ja"), ("a1b2c3", ""), ("éa", "fr"), ("\U0001d504 𝔄", "m"), ("no label", None)])],
        docs_schema := "doc_id long, text string, lang string, source string, n_chars long"))
    want = brute(rows_of(docs))
    got = judged(docs)
    same(got, want)
    by_id = {g[0]: g for g in got}
    assert by_id[100][2:] == by_id[101][2:] == by_id[102][2:] == by_id[400][2:] == ("und", 0.0) and len(got) == docs.count()
    same(judged(clashing(docs, ["gram", "n", "total", "held_out", "lang_pred", "score"])), want)
    assert judged(empty(spark)) == []
    assert {g[2] for g in judged(spark.createDataFrame([(1, "some text", None, None, 0), (2, "more", None, None, 0)], docs_schema))} == {"und"}


def test_pieces_change_nothing(spark, monkeypatch):
    docs = odd_documents(spark).where("doc_id IS NULL OR doc_id <> 105")  # a text without white space is cut
    want = judged(docs)
    for piece in (20, 100, 1000):
        monkeypatch.setattr(L, "PIECE", piece)
        monkeypatch.setattr(L, "HELD_GRAMS", 50 * piece)
        assert sorted(judged(docs), key=str) == sorted(want, key=str)


def test_many_languages_and_crowded_filters(spark, monkeypatch):
    """Over 64 languages take several words a row; the correction holds where filters are nearly full."""
    rng = random.Random(9)
    alphabet = [chr(c) for c in range(0x561, 0x587)] + [chr(c) for c in range(0x430, 0x450)]
    lists = [["".join(rng.choice(alphabet) for _ in range(5)) for _ in range(40)] for _ in range(70)]
    rows = [(i, " ".join(rng.choice(lists[i % 70]) for _ in range(60)), f"l{i % 70:02}", None, 0) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    filters = L.fit(L.folds(docs).where("NOT held_out"), SHARE)
    assert len(filters.langs) == 70 and filters.masks.shape == (L.bits(SHARE), 2) and filters.masks.dtype == np.uint64
    truth = {i: lang for i, _, lang, _, _ in rows}
    assert all(p == truth[i] for i, _, p, _ in judged(docs))
    monkeypatch.setattr(L, "BITS_A_GRAM", 1)  # 1024 positions, a third of all answers wrong
    got = judged(docs)
    assert np.mean([p == truth[i] for i, _, p, _ in got]) > 0.95 and np.mean([s for *_, s in got]) > 0.9


@pytest.mark.parametrize("text,want", [("", []), ("A", [" a "]), ("ab", [" ab", "ab "]), ("a-b", [" a ", " b "]), ("9 9", [])])
def test_grams_of_small_texts(text, want):
    got = [g for owner, gram in L._grams([text], (3,), L._letters()) for g in gram.tolist()]
    assert len(got) == len(want) == len(set(got)) and plain_grams(text, (3,)) == want


def test_grams_keep_their_text():
    texts = ["one two", "", "  three!! ", "four", "?"]
    got = Counter(o for owner, _ in L._grams(texts, L.ORDERS, L._letters()) for o in owner.tolist())
    assert got == {i: len(plain_grams(t)) for i, t in enumerate(texts) if re.search("[a-z]", t)}


def test_letters():
    assert L._letters().tolist() == [chr(c).isalpha() for c in range(0x110000)]
