"""Operator 4: an exact round trip, capacity and padding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from tests.llm.helpers import clashing, empty, odd_documents

from farelane.llm import window_packing as P
from farelane.llm import word_tokens as W


def _check(rows, capacity=4096):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for some in by.values():
        some.sort(key=lambda r: r.offset)
        assert [r.offset for r in some] == np.cumsum([0] + [r.length for r in some[:-1]]).tolist()
        assert sum(r.length for r in some) <= capacity
    return by


def test_every_id_lies_in_one_piece(spark):
    df = odd_documents(spark)
    rows = P.pack_documents(clashing(df, ["start", "length", "place", "sequence_id", "pack_group"])).collect()
    _check(rows)
    t = W._tokenizer(W.tokenizer_path())[0]
    want = Counter()
    for r in df.collect():
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        full = len(ids) - len(ids) % 4096
        for a in [*range(0, full, 4096), *range(full, len(ids), P.TAIL_PIECE)]:
            n = min(4096 if a < full else P.TAIL_PIECE, len(ids) - a)
            want[r.doc_id, a, n, zlib.crc32(ids[a:a + n].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want


def test_little_padding(spark, sf):
    rows = P.pack_documents(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    by = _check(rows)
    assert sum(r.length for r in rows) >= 0.97 * 4096 * len(by)


def test_differencing_balances_and_windows_rise_when_full():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1024, 800)
    slots = P.near_equal_windows(sizes)
    sums = np.bincount(slots, sizes)
    assert len(sums) == -(-sizes.sum() // 4096) and sums.max() - sums.min() < 64 and sums.max() <= 4096
    # three halves and a bit cannot share two windows
    assert len(set(P.near_equal_windows([2100, 2100, 2100]))) == 3
    assert P.near_equal_windows([]).tolist() == [] and P.near_equal_windows([4096, 4096]).tolist() in ([0, 1], [1, 0])
    best = P.differencing([8, 7, 6, 5, 4], 2)
    assert abs(int(np.bincount(best, [8, 7, 6, 5, 4])[0]) - 15) <= 1  # the classic: 16 and 14


def test_empty_table_and_groups(spark):
    assert P.pack_documents(empty(spark)).count() == 0
    pieces = P.document_pieces(odd_documents(spark))
    rows = P.pack(pieces, windows_a_group=2, pieces_a_group=16).collect()
    _check(rows)
    assert len({r.sequence_id >> 32 for r in rows}) > 3 and len(rows) == pieces.count()


def test_a_task_leaves_no_memory_of_words_behind(monkeypatch):
    """Texts are split a bounded number of bytes at a time with the same ids, and what was remembered goes at the task's end."""
    path = W.tokenizer_path()
    texts = pa.array([f"word{i} other{i * 7}, and the rest of it." for i in range(300)] + [None, "", "x " * 500])
    want = [ids.tolist() for _, ids in W.token_ids(texts, path, 2)]
    met = []
    real = W.words_of
    monkeypatch.setattr(W, "words_of", lambda t: met.append(sum(len(x or "") for x in t.to_pylist())) or real(t))
    monkeypatch.setattr(W, "TEXT_BYTES", 400)
    got = list(W.token_ids(texts, path, 2))
    assert [i for i, _ in got] == list(range(303)) and [ids.tolist() for _, ids in got] == want
    assert W.token_counts(texts, path).tolist() == [len(x) - 1 for x in want]
    assert max(met[:-1]) <= 1000 and len(met) > 20
    assert W._KNOWN
    W.forget()
    assert not W._KNOWN and W.KNOWN_PIECES <= 250_000


def test_a_word_is_encoded_once_whatever_its_case_and_marks():
    """Ids are those of whole texts, and the tokenizer, which takes most of the time, meets a word's letters once."""
    import random

    path = W.tokenizer_path()
    whole = W._tokenizer(path)[0]
    rng = random.Random(8)
    alphabet = list("abEFKßéÉİıΣσςǅﬁªºⅷ漢か.,!'*$<|>42٣") + ["H̱", "i̇", "é", "'s", "n't", "\x01", "\xa0", "<|endoftext|>"]
    ends = ["", ".", ",", "...", "!!", "***", ")%,", "'", "'s", "&&&.", "§"]
    texts = [" ".join("".join(rng.choices(alphabet, k=rng.randint(1, 6))) + rng.choice(ends) for _ in range(rng.randint(0, 6))) for _ in range(3000)]
    texts += ["Aİ, bİ.", None, ""]
    want = [whole.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]
    W.forget()
    for a in (pa.array(texts), pa.array(["first", *texts]).slice(1)):  # the second time all pieces are known
        assert [ids.tolist() for _, ids in W.token_ids(a, path, 2)] == want
    W.forget()
    list(W.token_ids(pa.array(["Word word WORD, word. Word*** word!? (word) Étá étá, ÉTÁ***"]), path, 2))
    assert set(W._KNOWN[path][0].to_pylist()) == {"word", "étá", "(word", ",", ".", "***", "!?", ")"}
    W.forget()
