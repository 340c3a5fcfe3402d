"""Operator 1 against counts by the tokenizer itself."""

from collections import Counter

from tests.llm.helpers import clashing, empty, odd_documents, rows_of

from farelane.llm import length_histogram as H
from farelane.llm import word_tokens as W


def _brute(df):
    t = W._tokenizer(W.tokenizer_path())[0]
    return [len(t.encode(r.text or "", add_special_tokens=False).ids) for r in df.collect()]


def test_histogram_and_answers_equal_brute_force(spark):
    df = odd_documents(spark)
    lengths = _brute(df)
    hist = H.length_histogram(H.length_counts(clashing(df, ["n_tokens", "docs", "part"])), lengths_a_range=16).cache()
    rows = {r.n_tokens: r for r in hist.collect()}
    assert {k: r.docs for k, r in rows.items()} == Counter(lengths)
    for n, r in rows.items():
        assert r.docs_at_least == sum(x >= n for x in lengths) and r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert r.kept_tokens == sum(min(x, n) for x in lengths) and abs(r.share - sum(x <= n for x in lengths) / len(lengths)) < 1e-12
    limits = [0, 1, 7, 50, 333, 10**6]
    for r in H.answer_limits(hist, limits).collect():
        assert r.kept_tokens == sum(min(x, r.limit) for x in lengths) and r.docs_cut == sum(x > r.limit for x in lengths)
        assert r.lost_tokens == sum(lengths) - r.kept_tokens
    got = {r.share_asked: r.n_tokens for r in H.quantiles(hist, [0.1, 0.5, 1.0]).collect()}
    ordered = sorted(lengths)
    assert got == {q: next(x for x in ordered if sum(y <= x for y in lengths) / len(lengths) >= q) for q in (0.1, 0.5, 1.0)}
    assert {r.doc_id: r.n_tokens for r in H.document_lengths(df).collect()}[104] == dict(zip([r.doc_id for r in df.collect()], lengths))[104]


def test_empty_table_and_repeats(spark):
    assert H.length_histogram(H.length_counts(empty(spark))).count() == 0
    df = odd_documents(spark)
    assert rows_of(H.length_counts(df)) == rows_of(H.length_counts(df.repartition(7)))


def test_words_are_encoded_as_whole_texts_are(spark):
    import pyarrow as pa

    texts = ["Ἀθήνας ΟΔΟΣ ΟΔΟΣ, İstanbul. ÉÀ, éa. ÉA x.y 3.,. ...,a. ǅa ﬁn ªº ⅷ it's. don'T", "!,*** a.b.. 42nd. <|endoftext|>  x　y", None, "", "a"]
    t = W._tokenizer(W.tokenizer_path())[0]
    want = [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]
    whole = pa.array(["skip me", *texts])
    for a in (pa.array(texts), whole.slice(1)):
        assert [ids.tolist() for _, ids in W.token_ids(a, W.tokenizer_path(), 2)] == want
