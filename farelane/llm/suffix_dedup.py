"""Removal of repeated byte strings by bucket-pointer refinement (operator 3).

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier is
removed, where earlier is a smaller document id, or the same document and an
earlier start. The method is that of suffix sorting by bucket refinement, cut
off at the depth that matters:

* A position's bucket is named by its first bytes. The name for 2m bytes is
  made from the name for m bytes at the position and the one m bytes later, so
  names once refined are used again by all later rounds, up to the whole
  length. Names are 64-bit hashes, so equal strings get equal names wherever
  they lie, without a global sort.
* The initial buckets are those of ``GRAM`` bytes. Of the positions inside a
  window of LENGTH bytes only one stands for it, that with the least name;
  equal windows choose equal positions, so it is enough to look at these
  anchors, about one position in 19.
* Round 1 sorts anchors by bucket, then by the refined name of all bytes of
  the windows they stand for. An anchor alone in its bucket is settled: its
  windows are new. So is one that repeats an earlier anchor with all its
  windows: they are old. Only the first of each kind in buckets of several
  kinds go on.
* Round 2 sorts the windows of those by their full names: all but the first
  of each are old.

Texts are written once, as compressed chunks, which every round reads. What
crosses the shuffle for an anchor is packed to some 15 bytes, by chunk and
range of names; inside a chunk, repeats of an anchor's windows are settled
first, and a bucket with many kinds in one chunk goes to round 2 whole, so
that a range of names never gathers more than a few entries of a bucket from
each chunk however often it occurs.

Defined results: null and empty texts have no bytes; texts under LENGTH bytes
are kept whole; null ids come after all others; repeated rows are separate
documents, in order of their place in the input where the ids are equal, so
that one stays; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import col, keep, pieces_for, table, whole_text

LENGTH, GRAM = 100, 64
SPAN = LENGTH - GRAM + 1
CHUNK_BYTES, SLAB, RANGE_BYTES = 8 << 20, 1 << 17, 16 << 20
#: Kinds of one bucket that a chunk sends to round 1; a bucket with more goes to round 2.
KINDS = 4
NEW, OLD, OPEN = 0, 1, 2
NULL_ID = np.iinfo(np.int64).max

_BYTES = np.random.default_rng(3).integers(0, 2**63, 256, dtype=np.uint64)


# --- names ------------------------------------------------------------------

def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two strings in a row, from their names."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x += b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the GRAM and of the LENGTH bytes at each position of ``data`` where there are so many."""
    name, m = {1: _BYTES[data]}, 1
    while m < 64:
        name[2 * m] = _join(name[m][:-m], name[m][m:])
        m *= 2
    most = _join(name[64][:-32], name[32][64:])
    return name[64], _join(most[:-4], name[4][96:])


def windows(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, np.ndarray]]:
    """Anchors of texts that lie in a row in ``data``, slab by slab.

    (first window, last window, bucket, refined name) of each anchor, windows
    numbered by their start; the slab's start; the names of its windows.
    """
    for at in range(0, len(data) - LENGTH + 1, SLAB):
        part = data[at:at + SLAB + LENGTH - 1]
        gram, full = names(part)
        n = len(full)
        key = (gram & ~np.uint64((1 << 24) - 1)) | np.arange(len(gram), dtype=np.uint64)
        m = 1
        while 2 * m <= SPAN:
            key = np.minimum(key[:-m], key[m:])
            m *= 2
        least = np.minimum(key[:n], key[SPAN - m:SPAN - m + n])  # over SPAN positions
        place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        # windows that reach beyond their text stand for nothing
        a, b = np.searchsorted(ends, (at, at + n - 1), "right")
        last_ok = np.repeat(ends[a:b + 1] - LENGTH, np.diff(np.minimum(ends[a:b + 1], at + n), prepend=at))
        place[np.arange(at, at + n) > last_ok] = -1
        cut = np.flatnonzero(place[1:] != place[:-1]) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [n]]) - 1
        anchor = place[lo]
        lo, hi, anchor = lo[anchor >= 0], hi[anchor >= 0], anchor[anchor >= 0]
        shape = ((hi - lo) << 8 | (anchor - lo)).astype(np.uint64)
        yield lo + at, hi + at, gram[anchor], _join(_join(full[lo], full[hi]), shape), at, full


# --- messages ---------------------------------------------------------------

def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    return zstandard.compress(len(head).to_bytes(4, "little") + head + b"".join(a.tobytes() for a in arrays), level)


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    n = int.from_bytes(data[:4], "little")
    out, at = [], 4 + n
    for x in data[4:at].decode().split(";"):
        kind, size = x.split(",")
        out.append(np.frombuffer(data, np.dtype(kind), int(size), at))
        at += out[-1].nbytes
    return out


def _steps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new group starts in arrays sorted by ``keys``."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


def _sent(which: np.ndarray, ranges: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Messages of one chunk: columns (the last two: ids and numbers, in rising order of numbers) by range."""
    order = np.argsort(which, kind="stable")
    cuts = np.searchsorted(which[order], np.arange(ranges + 1))
    for r in range(ranges):
        i = order[cuts[r]:cuts[r + 1]]
        if len(i):
            yield r, pack(*[c[i] for c in columns[:-2]], _steps(columns[-2][i]), _steps(columns[-1][i]))


def _received(t: pa.Table) -> list[np.ndarray]:
    """All messages of a range, columns in a row, with the chunk of each entry before the numbers."""
    parts = []
    for chunk, message in zip(t.column("chunk").to_pylist(), t.column("message")):
        *columns, ids, numbers = unpack(message.as_py())
        parts.append([*columns, np.cumsum(ids), np.full(len(ids), chunk), np.cumsum(numbers)])
    return [np.concatenate(x) for x in zip(*parts)]


def _replies(chunk: np.ndarray, number: np.ndarray, verdict: np.ndarray) -> pa.Table:
    order = np.lexsort((number, chunk))
    chunk, number, verdict = chunk[order], number[order], verdict[order]
    cut = np.flatnonzero(_runs(chunk))
    rows = [(int(chunk[a]), pack(_steps(number[a:b]), verdict[a:b])) for a, b in zip(cut, [*cut[1:], len(chunk)])] if len(chunk) else []
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["of_chunk", "verdicts"])


REPLIES = "of_chunk bigint, verdicts binary"


# --- the rounds -------------------------------------------------------------

MESSAGES = "chunk bigint, `range` int, message binary"
_SCHEMA = pa.schema([("chunk", pa.int64()), ("range", pa.int32()), ("message", pa.binary())])


def chunk_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(chunk, message): texts in a row, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        for b in batches:
            sizes = np.cumsum(pc.binary_length(b.column(1)).to_numpy())
            first = 0
            while first < b.num_rows:
                base = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, base + CHUNK_BYTES, "right")))
                ids = pc.fill_null(b.column(0).slice(first, last - first), NULL_ID).to_numpy()
                data = np.frombuffer(b"".join([x.as_buffer() for x in b.column(1).slice(first, last - first)]), np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([pack(ids, sizes[first:last] - base, data, level=6)])], ["chunk", "message"])
                chunk, first = chunk + 1, last
            pa.default_memory_pool().release_unused()

    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "chunk bigint, message binary")


def anchors(texts: DataFrame, ranges: int) -> DataFrame:
    """Round 1's messages (local false), and what each chunk settles by itself (local true), by range."""

    def chunk_rows(ids: np.ndarray, ends: np.ndarray, data: np.ndarray, chunk: int) -> list[tuple]:
        parts = [(ids[np.searchsorted(ends, lo, "right")], bucket, name) for lo, _, bucket, name, _, _ in windows(data, ends)]
        if not parts:
            return []
        of, bucket, name = (np.concatenate(x) for x in zip(*parts))
        status = np.full(len(of), NEW, np.uint8)
        order = np.lexsort((np.arange(len(of)), of, name, bucket))
        b, x = bucket[order], name[order]
        first = _runs(b, x)
        status[order[~first]] = OLD
        # buckets of many kinds: all kinds go to round 2, one tells the others of the bucket
        group = np.cumsum(_runs(b)) - 1
        many = np.bincount(group, first)[group] > KINDS
        status[order[first & many]] = OPEN
        sent = np.sort(order[first & (~many | _runs(b))])
        crowded = np.zeros(len(of), np.uint8)
        crowded[order[many]] = 1
        which = ((bucket[sent] & np.uint64(0xFFFFFFFF)) % np.uint64(ranges)).astype(np.int64)
        rows = [(r, chunk, False, m) for r, m in _sent(which, ranges, (bucket[sent] >> np.uint64(32)).astype(np.uint32),
                                                        name[sent].astype(np.uint32), (name[sent] >> np.uint64(48)).astype(np.uint16), crowded[sent], of[sent], sent)]
        some = np.flatnonzero(status)
        return rows + [(chunk % ranges, chunk, True, pack(_steps(some), status[some]))] if len(some) else rows

    schema = pa.schema([("range", pa.int32()), ("chunk", pa.int64()), ("local", pa.bool_()), ("message", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, message in zip(b.column(0).to_pylist(), b.column(1)):
                rows = chunk_rows(*unpack(message.as_py()), chunk)
                if rows:
                    yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
                pa.default_memory_pool().release_unused()

    return texts.select("chunk", "message").mapInArrow(run, "`range` int, chunk bigint, local boolean, message binary")


def _judge_anchors(t):
    """Round 1: OLD for all but the first of a kind, OPEN for the first of each kind in buckets of several kinds."""
    settled = t.filter(t.column("local")).select(["chunk", "message"]).rename_columns(["of_chunk", "verdicts"])
    t = t.filter(pc.invert(t.column("local")))
    if not t.num_rows:
        return settled
    bucket, low, high, crowded, ids, chunk, number = _received(t)
    name = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)  # 48 bits: they only tell the kinds of a bucket apart
    order = np.lexsort((number, chunk, ids, name, bucket))
    b, x = bucket[order], name[order]
    first, group = _runs(b, x), np.cumsum(_runs(b)) - 1
    several = (np.bincount(group, first) > 1) | (np.bincount(group, crowded[order]) > 0)
    # a crowded entry stands for its bucket, not for its kind: it is open already
    verdict = np.where(crowded[order] > 0, NEW, np.where(~first, OLD, np.where(several[group], OPEN, NEW))).astype(np.uint8)
    some = verdict != NEW
    return pa.concat_tables([settled, _replies(chunk[order][some], number[order][some], verdict[some])])


def _judge_windows(t):
    """Round 2: OLD for all but the first of equal windows."""
    name, ids, chunk, number = _received(t)
    order = np.lexsort((number, chunk, ids, name))
    old = order[~_runs(name[order])]
    return _replies(chunk[old], number[old], np.full(len(old), OLD, np.uint8))


def _verdicts(messages) -> tuple[np.ndarray, np.ndarray]:
    got = [unpack(x) for x in messages]
    return (np.concatenate([np.cumsum(n) for n, _ in got]), np.concatenate([v for _, v in got])) if got else (np.zeros(0, np.int64), np.zeros(0, np.uint8))


def _cover(steps: np.ndarray, starts: np.ndarray, last: np.ndarray | None = None) -> None:
    """Count windows from ``starts`` (to ``last``) over their bytes, as steps up and down."""
    np.add.at(steps, starts, 1)
    np.add.at(steps, (starts if last is None else last) + LENGTH, -1)


def _second(ranges: int):
    def run(key, texts, replies):
        """Settle a chunk's anchors; send the windows of open ones, and (range null) the chunk's state for the end."""
        chunk, rows = key[0].as_py(), []
        for message in texts.column("message"):
            ids, ends, data = unpack(message.as_py())
            number, verdict = _verdicts(replies.column("verdicts").to_pylist())
            status = np.full(number.max(initial=-1) + 1, NEW, np.uint8)
            status[number] = verdict
            steps = np.zeros(len(data) + 1, np.int32)
            starts, name, seen = [], [], 0
            for lo, hi, _, _, at, full in windows(data, ends):
                s = np.full(len(lo), NEW, np.uint8)  # anchors after the last verdict are new
                told = status[seen:seen + len(lo)]
                s[:len(told)] = told
                seen += len(lo)
                _cover(steps, lo[s == OLD], hi[s == OLD])
                a, n = lo[s == OPEN], (hi - lo + 1)[s == OPEN]
                w = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                starts.append(w)
                name.append(full[w - at])
            starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
            name = np.concatenate(name) if name else np.zeros(0, np.uint64)
            of = ids[np.searchsorted(ends, starts, "right")]
            order = np.lexsort((np.arange(len(starts)), of, name))
            first = _runs(name[order])
            _cover(steps, starts[order[~first]])
            sent = np.sort(order[first])
            starts, name, of = starts[sent], name[sent], of[sent]
            which = ((name >> np.uint64(7)) % np.uint64(ranges)).astype(np.int64)
            rows += [(chunk, r, m) for r, m in _sent(which, ranges, name, of, np.arange(len(starts)))]
            rows.append((chunk, None, pack(np.packbits(np.cumsum(steps[:-1], dtype=np.int32) > 0), _steps(starts))))
        pa.default_memory_pool().release_unused()
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    return run


def _last(_, texts, rest):
    """One row per document, without what either round found old."""
    names_ = [c.split(" ")[0] for c in RESULT.split(", ")]
    columns = [[] for _ in names_]
    state = [x.as_py() for x, s in zip(rest.column("verdicts"), rest.column("state")) if s.as_py()]
    number, _ = _verdicts([x.as_py() for x, s in zip(rest.column("verdicts"), rest.column("state")) if not s.as_py()])
    for message, (bits, starts) in zip(texts.column("message"), map(unpack, state), strict=True):
        ids, ends, data = unpack(message.as_py())
        steps = np.zeros(len(data) + 1, np.int32)
        _cover(steps, np.cumsum(starts)[number])
        removed = (np.cumsum(steps[:-1], dtype=np.int32) > 0) | np.unpackbits(bits, count=len(data)).astype(bool)
        for doc_id, a, b in zip(ids.tolist(), [0, *ends[:-1]], ends):
            gone = removed[a:b]
            spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            row = (None if doc_id == NULL_ID else doc_id, int(b - a), int(gone.sum()), spans, hashlib.sha256(data[a:b][~gone].tobytes()).hexdigest())
            for c, v in zip(columns, row):
                c.append(v)
    pa.default_memory_pool().release_unused()
    return pa.table([pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(columns)], names_)


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    size = docs.agg(F.sum(F.octet_length(whole_text(text_col)).cast("bigint")).alias("n")).first().n
    ranges = pieces_for(float(size or 0), RANGE_BYTES)
    texts = keep(chunk_texts(docs, id_col, text_col))
    settled = anchors(texts, ranges).groupBy("range").applyInArrow(_judge_anchors, REPLIES)
    second = keep(texts.groupBy("chunk").cogroup(settled.groupBy("of_chunk")).applyInArrow(_second(ranges), MESSAGES))
    found = second.where("range IS NOT NULL").groupBy("range").applyInArrow(_judge_windows, REPLIES)
    state = second.where("range IS NULL").select(F.col("chunk").alias("of_chunk"), F.col("message").alias("verdicts"), F.lit(True).alias("state"))
    rest = state.unionByName(found.withColumn("state", F.lit(False)))
    return texts.groupBy("chunk").cogroup(rest.groupBy("of_chunk")).applyInArrow(_last, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: what is left of every document."""
    return remove_repeats(table(spark, sf_dir, "documents"))
