"""Token ids of whole texts with a public word tokenizer, one distinct word at a time.

The tokenizer's rules never look across ASCII white space (it drops white
space and marks word ends), so a text's ids are its words' ids in a row. Each
Arrow batch is split into words, every distinct word is encoded once, and ids
are gathered by index.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from farelane.llm.common import give_back

#: Words of a batch whose ids are gathered at a time (bounds a task's memory).
WORDS_AT_ONCE = 500_000
#: Bytes of texts of a batch that are split into words at a time; a longer text is alone.
TEXT_BYTES = 16 << 20
#: Pieces of words that a task remembers, about 40 bytes each; the rare ones beyond the most frequent are hardly met again.
KNOWN_PIECES = 250_000
#: ASCII characters that are no letter, digit, white space or control character.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_LOADED: dict = {}
_KNOWN: dict = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(path: str):
    """(the tokenizer, the same model for lower-case letters alone and for ASCII ones, which of its ids end a word)."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True  # their strings in a text are ordinary text
        letters, ascii_letters = Tokenizer(t.model), Tokenizer(t.model)
        letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ascii_letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()  # their bytes stand for themselves
        vocabulary = t.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[v for k, v in vocabulary.items() if k.endswith("</w>")]] = True
        _LOADED[path] = t, letters, ascii_letters, ends
    return _LOADED[path]


def large(texts: pa.Array) -> pa.Array:
    """``texts`` with 64-bit offsets and null as empty.

    A slice is copied first: casting one leaves offsets that do not start at
    0, which some of Arrow's string functions (version 23) read wrongly.
    """
    if texts.offset:
        texts = texts.take(pa.array(np.arange(len(texts))))
    return pc.fill_null(texts, "").cast(pa.large_string())


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first word of each text and the end, word numbers, distinct words) of a string array; null texts have no words."""
    split = pc.ascii_split_whitespace(large(texts))
    starts = split.offsets.to_numpy() - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    return starts, coded.indices.to_numpy(), coded.dictionary


def _letters(core: str) -> str | None:
    """A core of letters alone, lower-cased as the tokenizer would: composed, and without the one letter whose lower case depends on its neighbours."""
    if core.isalpha() and (core.isascii() or (is_normalized("NFC", core) and "\u03a3" not in core)):
        low = core.lower()
        return low if low.isalpha() and is_normalized("NFC", low) else None
    return None


def _keys(pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(what a piece is remembered under, whether that is lower-case letters alone): such a piece by its lower case, another by itself."""
    plain = pc.ascii_is_alpha(pieces)
    keys = pc.if_else(plain, pc.ascii_lower(pieces), pieces)
    foreign = pc.invert(pc.string_is_ascii(pieces))
    some = pieces.filter(foreign).to_pylist()
    low = [_letters(p) for p in some]
    keys = pc.replace_with_mask(keys, foreign, pa.array([x or p for x, p in zip(low, some, strict=True)], keys.type))
    plain = plain.to_numpy(zero_copy_only=False).copy()
    plain[foreign.to_numpy(zero_copy_only=False)] = [bool(x) for x in low]
    return keys, plain


def _encode_keys(keys: pa.Array, plain: np.ndarray, path: str, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, ids) of keys. A code is its first id's place after ``base``, whether it ends in a letter, and its length (under 2**24), in one number."""
    whole, letters, ascii_letters, ends = _tokenizer(path)
    codes, out = np.zeros(len(keys), np.int64), [np.zeros(0, np.uint32)]
    is_ascii = pc.string_is_ascii(keys).to_numpy(zero_copy_only=False)
    for tokenizer, rows in ((ascii_letters, np.flatnonzero(plain & is_ascii)), (letters, np.flatnonzero(plain & ~is_ascii))):
        cuts = np.append(np.arange(0, len(rows), 1000), len(rows))
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), keys.take(pa.array(rows)).cast(pa.string())), " ") if len(rows) else []
        got = [np.array(tokenizer.encode_batch_fast([line.as_py()], add_special_tokens=False)[0].ids, np.uint32) for line in lines]
        got = np.concatenate(got) if got else out[0]
        last = np.flatnonzero(ends[got]) + 1
        lengths = np.diff(last, prepend=0)
        codes[rows] = (base + last - lengths) << 25 | 1 << 24 | lengths
        out.append(got)
        base += len(got)
    other = np.flatnonzero(~plain)
    pieces = keys.take(pa.array(other)).to_pylist()
    for at in range(0, len(pieces), 1000):
        some = pieces[at:at + 1000]
        got = [e.ids for e in whole.encode_batch_fast(some, add_special_tokens=False)]
        lengths = np.array([len(x) for x in got], np.int64)
        letter = np.array([p.lower()[-1:].isalpha() for p in some], np.int64)
        codes[other[at:at + 1000]] = (base + np.cumsum(lengths) - lengths) << 25 | letter << 24 | lengths
        out += [np.array(x, np.uint32) for x in got]
        base += int(lengths.sum())
    return codes, np.concatenate(out)


def gather(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Slices of ``values``, one after the other."""
    ends = np.cumsum(lengths)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


def _tails(words: pa.Array, kept: np.ndarray, rows: np.ndarray) -> pa.Array:
    """What follows the first ``kept`` bytes of those words."""
    words = words.take(pa.array(rows))
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    starts = ends[:-1] + kept[rows]
    lengths = ends[1:] - starts
    data = gather(starts, lengths, np.frombuffer(words.buffers()[2], np.uint8))
    return pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)])), pa.py_buffer(data))


def encode_words(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, ids): the ids of word k are ``ids[start[k]:start[k] + length[k]]``.

    The tokenizer splits marks at a word's end from a letter before them, so
    such a word is its core and its marks. A task remembers the pieces it has
    encoded, up to ``KNOWN_PIECES``; then it starts anew. That only saves time.
    """
    if path not in _KNOWN or len(_KNOWN[path][0]) > KNOWN_PIECES:
        _KNOWN[path] = pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def look_up(pieces: pa.Array) -> np.ndarray:
        known, codes, ids = _KNOWN[path]
        coded = pieces.dictionary_encode()
        keys, plain = _keys(coded.dictionary)
        distinct = keys.dictionary_encode()
        number = distinct.indices.to_numpy()
        letters = np.zeros(len(distinct.dictionary), bool)
        letters[number] = plain
        place = pc.fill_null(pc.index_in(distinct.dictionary, value_set=known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            fresh = distinct.dictionary.take(pa.array(new))
            more, got = _encode_keys(fresh, letters[new], path, len(ids))
            place[new] = len(known) + np.arange(len(new))
            codes = np.concatenate([codes, more])
            _KNOWN[path] = pa.concat_arrays([known, fresh]), codes, np.concatenate([ids, got])
        return codes[place][number][coded.indices.to_numpy()]

    core = pc.ascii_rtrim(words, MARKS)
    kept, all_ = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (core, words))
    marked = (kept > 0) & (kept < all_)
    first = look_up(pc.if_else(pa.array(marked), core, words))
    wrong = np.flatnonzero(marked & (first >> 24 & 1 == 0))
    if len(wrong):
        first[wrong] = look_up(words.take(pa.array(wrong)))
        marked[wrong] = False
    rest = np.zeros(len(words), np.int64)
    if marked.any():
        rest[marked] = look_up(_tails(words, kept, np.flatnonzero(marked)))
    both = np.stack([first, rest], axis=1).ravel()
    lengths = (both & 0xFFFFFF).reshape(-1, 2).sum(axis=1)
    return np.cumsum(lengths) - lengths, lengths, gather(both >> 25, both & 0xFFFFFF, _KNOWN[path][2])


def forget() -> None:
    """Give back what a task remembers."""
    _KNOWN.clear()
    give_back()


def _spans(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first text, texts) of about ``TEXT_BYTES`` each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + TEXT_BYTES, "right")))
        yield first, texts.slice(first, last - first)
        first = last


def token_counts(texts: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text."""
    out = [np.zeros(0, np.int64)]
    for _, some in _spans(texts):
        starts, numbers, words = words_of(some)
        _, lengths, _ = encode_words(words, path)
        total = np.concatenate([[0], np.cumsum(lengths[numbers])])
        out.append(total[starts[1:]] - total[starts[:-1]])
    return np.concatenate(out)


def token_ids(texts: pa.Array, path: str, end_id: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(index, ids) of each text, ``end_id`` after them; texts are gathered a bounded number of words at a time."""
    tail = np.asarray([] if end_id is None else [end_id], np.uint32)
    for base, span in _spans(texts):
        starts, numbers, words = words_of(span)
        offsets, lengths, ids = encode_words(words, path)
        first = 0
        while first < len(span):
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + WORDS_AT_ONCE, "right")) - 1)
            some = numbers[starts[first]:starts[last]]
            flat, ends = gather(offsets[some], lengths[some], ids), np.concatenate([[0], np.cumsum(lengths[some])])
            cuts = ends[starts[first:last + 1] - starts[first]]
            for i in range(first, last):
                yield base + i, np.concatenate([flat[cuts[i - first]:cuts[i - first + 1]], tail])
            first = last
