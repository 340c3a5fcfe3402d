"""MD5 of many short texts at once: one numpy step serves a whole batch of row keys.

The digests are those of any other MD5 (``hashlib``, Spark, DuckDB), so what is
drawn from them here can be drawn by any engine. A text that does not fit one
MD5 block is hashed by ``hashlib``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa

BLOCK, LONGEST = 64, 55  # bytes of an MD5 block, and of a text that fits it
# Digests that are made together.
AT_ONCE = 1 << 15

_K = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_TURN = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_WORD = [(1, 0), (5, 1), (3, 5), (7, 0)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


_SHIFT = [np.uint32(i) for i in range(33)]


def _one_block(words: list[np.ndarray | int], shape: tuple[int, int]) -> list[np.ndarray]:
    """The state after one block of 16 little-endian words, each one number or an array that goes with ``shape``."""
    a, b, c, d = (np.full(shape, x, np.uint32) for x in _START)
    t, u = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    add, xor, both, either, left, right = np.add, np.bitwise_xor, np.bitwise_and, np.bitwise_or, np.left_shift, np.right_shift
    for i in range(64):
        part = i // 16
        if part == 0:
            xor(c, d, t), both(t, b, t), xor(t, d, t)
        elif part == 1:
            xor(b, c, t), both(t, d, t), xor(t, c, t)
        elif part == 2:
            xor(b, c, t), xor(t, d, t)
        else:
            np.invert(d, t), either(t, b, t), xor(t, c, t)
        step, first = _WORD[part]
        word, turn = words[(first + step * i) % 16], _TURN[part][i % 4]
        add(a, t, a)
        if isinstance(word, np.ndarray):
            add(a, word, a)
            word = 0
        add(a, np.uint32((_K[i] + word) & 0xFFFFFFFF), a)
        right(a, _SHIFT[32 - turn], u), left(a, _SHIFT[turn], a), either(a, u, a)
        add(a, b, a)
        a, b, c, d = d, a, b, c
    return [x + np.uint32(s) for x, s in zip((a, b, c, d), _START)]


class KeyTexts:
    """Texts of an Arrow string column without nulls, ready to be hashed behind prefixes."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        n, (_, offsets, data) = len(column), column.buffers()
        offsets = np.frombuffer(offsets, np.int64, n + 1, 8 * column.offset)
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
        self.column, self.sizes = column, np.diff(offsets)
        width = min(int(self.sizes.max(initial=0)), LONGEST)
        at = np.arange(width + 1)
        self.bytes = data[np.minimum(offsets[:-1, None] + at, len(data) - 1)]
        self.bytes[at > self.sizes[:, None]] = 0
        short = np.flatnonzero(self.sizes <= width)
        self.bytes[short, self.sizes[short]] = 0x80  # the end of an MD5 message
        self.words: dict[tuple[int, bytes], list[np.ndarray]] = {}

    def __len__(self) -> int:
        return len(self.sizes)

    def _varying(self, prefix: bytes) -> tuple[int, list[np.ndarray]]:
        """Number of the first word that holds a part of a text, and the words from there on."""
        first = len(prefix) // 4
        tail = prefix[4 * first:]
        if (first, tail) not in self.words:
            width = min(self.bytes.shape[1], BLOCK - 8 - len(prefix))
            block = np.zeros((len(self), 4 * -(-(len(tail) + width) // 4)), np.uint8)
            block[:, :len(tail)] = np.frombuffer(tail, np.uint8)
            block[:, len(tail):len(tail) + width] = self.bytes[:, :width]
            self.words[first, tail] = list(np.ascontiguousarray(block.view("<u4").T))
        return first, self.words[first, tail]

    def md5(self, prefixes: list[str]) -> np.ndarray:
        """Digests of prefix + text as numbers by prefix, 32-bit part (first byte highest) and text."""
        n, heads = len(self), [p.encode() for p in prefixes]
        out = np.empty((len(heads), 4, n), np.uint32)
        groups: dict[tuple[int, bytes], list[int]] = {}
        for i, head in enumerate(heads):
            if len(head) <= LONGEST:
                groups.setdefault((len(head), head[len(head) // 4 * 4:]), []).append(i)
        for (size, _), alike in groups.items():
            first, varying = self._varying(heads[alike[0]])
            step, bits = max(1, AT_ONCE // max(n, 1)), (8 * (size + self.sizes)).astype(np.uint32)
            for own in (alike[i:i + step] for i in range(0, len(alike), step)):
                fixed = np.array([np.frombuffer(heads[i][:4 * first], "<u4") for i in own], np.uint32)
                words: list[np.ndarray | int] = [int(w[0]) if (w == w[0]).all() else w[:, None] for w in fixed.T]
                for at in range(0, n, AT_ONCE):
                    texts = slice(at, min(at + AT_ONCE, n))
                    block = [*words, *[w[texts] for w in varying]]
                    block += [0] * (16 - len(block))
                    block[14] = bits[texts]
                    for part, x in enumerate(_one_block(block, (len(own), texts.stop - at))):
                        out[own, part, texts] = x.byteswap()
        for i, head in enumerate(heads):
            for j in np.flatnonzero(len(head) + self.sizes > LONGEST).tolist():
                out[i, :, j] = np.frombuffer(hashlib.md5(head + self.column[j].as_py()).digest(), ">u4")
        return out

    def buckets(self, n: int) -> np.ndarray:
        """``operators.features.bucket_of``: a number in [0, n) from the first 52 bits of a digest."""
        high, low = self.md5(["bucket:"])[0, :2].astype(np.int64)
        return np.floor(((high << 20) | (low >> 12)) / 2.0**52 * n).astype(np.int64)
