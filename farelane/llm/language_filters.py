"""Language identification with language-bitmask n-gram filters (operator 11).

Training counts the letter n-grams of every labelled text by language. An
n-gram belongs to a language if it makes up at least ``share`` of the
language's n-grams, so a language holds at most 1 / share of them, however
large the corpus. Each language puts its n-grams into a Bloom filter of fixed
size; the filters are stored bit-sliced, as one row per bit position that
holds a bit for each language. Looking up an n-gram ANDs a few rows and
returns the languages that contain it, all at once.

A text is judged by the popcounts of these masks: per language, how many of
its n-grams the language contains. A filter whose bits are set to a share
``fill`` answers yes by mistake with probability p = fill^hashes, so a
popcount c of n becomes (c - n p) / (1 - p). The largest wins.

N-grams lie in words (runs of letters, lower case) with a space on either
side; they are named by 64-bit hashes. Texts are read in pieces of at most
``PIECE`` code points, cut at white space; n-gram counts are merged inside a
task before the shuffle. The driver and the tasks hold the sliced filter only,
``bits(share)`` rows of a bit per language (2 MB for up to eight languages).

Defined results: a null text, or one without a letter, is ``und`` with score
0, as is every text if nothing was learned; a null lang is not learned from,
an empty one is a language; a null id counts as the empty text for the fold,
which trains; equal corrected popcounts, or none above 0, go to the language
with more training n-grams, then to the smaller name; a stretch of over ``PIECE`` code points without a
space or line end is cut there; repeated rows each count and are each judged;
an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import col, keep, table

ORDERS = (3, 4)
#: Least share of a language's n-grams of all orders that an n-gram must have to be in its filter.
SHARE = 2e-5
HASHES = 3
BITS_A_GRAM = 16
#: Code points of texts that are worked on at a time.
PIECE = 1 << 19
#: Distinct n-grams that a task holds before it merges and hands them on.
HELD_GRAMS = 1 << 21
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
SPACE = 32


@dataclass
class Filters:
    """Bit-sliced filters: ``masks[position]`` holds bit i of word i // 64 for language i."""

    langs: list[str]  # by falling number of training n-grams, then name
    masks: np.ndarray  # positions x words, unsigned
    false_positive: np.ndarray  # by language


def bits(share: float) -> int:
    """Bit positions of each filter: a power of two, set by the most n-grams a language can hold."""
    return 1 << int(np.ceil(np.log2(BITS_A_GRAM / share)))


def _letters() -> np.ndarray:
    """Whether each code point is a letter; computed once a task."""
    return np.char.isalpha(np.arange(0x110000, dtype=np.uint32).view("<U1"))


def _pieces(texts: Iterable[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts and their numbers in turn, at most about ``PIECE`` code points at a time; longer texts are cut at white space."""
    rows, held, size = [], [], 0
    for i, text in enumerate(texts):
        at, text = 0, text or ""
        while True:
            end = len(text)
            if end - at > PIECE:
                cut = max(text.rfind(" ", at + 1, at + PIECE), text.rfind("\n", at + 1, at + PIECE))
                end = cut if cut > at else at + PIECE
            if held and size + end - at > PIECE:
                yield rows, held
                rows, held, size = [], [], 0
            rows.append(i)
            held.append(text[at:end])
            size, at = size + end - at, end
            if at == len(text):
                break
    if held:
        yield rows, held


def _grams(texts: list[str], orders: tuple[int, ...], letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in ``texts``, n-gram) arrays, an order at a time; n-grams as 64-bit hashes."""
    texts = [" " + t.lower() for t in texts]  # the space before a text is its own; that after it is the next one's
    code = np.frombuffer(("".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(letters[code], code, SPACE).astype(np.uint64)
    space = code == SPACE
    stays = np.ones(len(code), bool)
    stays[:-1] = ~(space[:-1] & space[1:])  # the last of a run of spaces stays
    lengths = np.array([len(t) for t in texts])
    lengths[-1] += 1
    owner, code, space = np.repeat(np.arange(len(texts)), lengths)[stays], code[stays], space[stays]
    name, inner = code, np.zeros(len(code), bool)  # inner: a space lies inside
    for n in range(2, max(orders) + 1):
        if len(code) < n:
            break
        if n > 2:
            inner = inner[:len(code) - n + 1] | space[n - 2:len(code) - 1]
        else:
            inner = inner[:-1]
        name = name[:len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1:]
        if n in orders:
            x = name[~inner] + np.uint64(n)
            x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            yield owner[:len(inner)][~inner], x ^ x >> np.uint64(32)


def _places(gram: np.ndarray, positions: int) -> Iterator[np.ndarray]:
    """The bit positions of each n-gram, one array per hash."""
    step = gram >> np.uint64(32) | np.uint64(1)
    for k in range(HASHES):
        yield ((gram + np.uint64(k) * step) & np.uint64(positions - 1)).astype(np.int64)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(gram)
    gram, n = gram[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    return gram[first], np.add.reduceat(n, first)


def count_grams(labelled: DataFrame, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """(lang, gram, n): how often each n-gram occurs in the texts of each language, of rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size, letters = 0, _letters()

        def merge() -> int:
            for lang in held:
                held[lang] = [_merged(held[lang])]
            return sum(len(parts[0][0]) for parts in held.values())

        def hand_on() -> Iterator[pa.RecordBatch]:
            for lang, [(gram, n)] in held.items():
                yield pa.record_batch([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for b in batches:
            langs = b.column(0).dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                rows = np.flatnonzero(langs.indices.to_numpy() == i).tolist()
                for _, texts in _pieces(b.column(1)[r].as_py() for r in rows):
                    for _, gram in _grams(texts, orders, letters):
                        parts = np.unique(gram, return_counts=True)
                        held.setdefault(lang, []).append(parts)
                        size += len(parts[0])
                    if size > HELD_GRAMS:
                        size = merge()
                        if size > HELD_GRAMS // 2:
                            yield from hand_on()
                            size = 0
        merge()
        yield from hand_on()

    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, share: float = SHARE, orders: tuple[int, ...] = ORDERS) -> Filters:
    """Learn the filters of all languages from every row (lang, text)."""
    counts = keep(count_grams(labelled, orders), "zstd")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    positions = bits(share)

    def fill(t: pa.Table) -> pa.Table:
        """One language's filter: at most 1 / share n-grams come here."""
        on = np.zeros(positions, bool)
        for at in _places(t.column("gram").to_numpy().view(np.uint64), positions):
            on[at] = True
        return pa.table([pa.array([t.column("lang")[0].as_py()]), pa.array([t.column("total")[0].as_py()]),
                         pa.array([np.packbits(on).tobytes()], pa.binary())], ["lang", "total", "on"])

    kept = counts.join(totals, "lang").where(F.col("n") >= share * F.col("total"))
    slices = kept.groupBy("lang").applyInArrow(fill, "lang string, total bigint, on binary").collect()
    slices.sort(key=lambda r: (-r.total, r.lang))
    narrow = next((t for t, n in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32)) if len(slices) <= n), np.uint64)
    masks = np.zeros((positions, max(1, -(-len(slices) // 64))), narrow)
    false_positive = np.zeros(len(slices))
    for i, r in enumerate(slices):
        on = np.unpackbits(np.frombuffer(r.on, np.uint8))
        masks[:, i // 64] |= on.astype(narrow) << narrow(i % 64)
        false_positive[i] = on.mean() ** HASHES
    return Filters([r.lang for r in slices], masks, false_positive)


def predict(docs: DataFrame, filters: Filters, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of rows (doc_id, held_out, text)."""
    langs = filters.langs
    sent = docs.sparkSession.sparkContext.broadcast((filters.masks, filters.false_positive))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, wrong = sent.value
        letters = _letters()
        kind = masks.dtype.type
        for b in batches:
            hits, n = np.zeros((len(langs), b.num_rows)), np.zeros(b.num_rows)
            for rows, texts in _pieces(v.as_py() for v in b.column(2)):
                rows = np.array(rows)
                for owner, gram in _grams(texts, orders, letters):
                    found = None
                    for at in _places(gram, len(masks)):
                        found = masks[at] if found is None else found & masks[at]
                    np.add.at(n, rows, np.bincount(owner, minlength=len(rows)))
                    for i in range(len(langs)):
                        has = (found[:, i // 64] >> kind(i % 64)) & kind(1)
                        np.add.at(hits[i], rows, np.bincount(owner, has, len(rows)))
            known = (n > 0) & (len(langs) > 0)
            right = np.zeros((max(1, len(langs)), b.num_rows))
            right[:len(langs)] = np.maximum((hits - n * wrong[:, None]) / np.maximum(1 - wrong[:, None], 1e-12), 0).round(9)
            best = right.argmax(axis=0)
            score = np.where(known, np.clip(right.max(axis=0) / np.maximum(n, 1), 0, 1), 0)
            pred = [langs[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist())]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def folds(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang, text)."""
    fold = F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS
    return docs.select(col(id_col).cast("bigint").alias("doc_id"), (fold == HELD_OUT).alias("held_out"),
                       col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text"))


def identify(docs: DataFrame, share: float = SHARE, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """Learn from the documents that are not held out, then judge all; ``docs`` as ``folds`` gives them."""
    return predict(docs, fit(docs.where("NOT held_out"), share, orders), orders)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the language of every document."""
    return identify(folds(table(spark, sf_dir, "documents")))
