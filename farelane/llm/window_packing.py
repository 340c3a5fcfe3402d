"""Packing token sequences with Karmarkar-Karp multiway differencing (operator 4).

Documents are encoded and cut at fixed places, so a piece is known without
moving its tokens: full windows first, which stand alone, then pieces of at
most ``tail`` tokens. The others are dealt at random into groups of a bounded
number of tokens and pieces, and each group is split into near-equal windows:
partial partitions, one sum for each window, wait in a heap by their spread;
the two of the largest spread are merged with opposing imbalances (the fullest
slot of one on the emptiest of the other) until one is left. The window count
starts at the fewest that could hold the group and rises by one whenever a
window exceeds the capacity.

Padding is therefore under one window for each group of ``windows_a_group``.

Defined results: a null or empty text is the end id alone; a null id is kept;
repeated rows are separate documents (dealt by their place in their task as
well, so that many repeats do not meet in one group); an empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import word_tokens
from farelane.llm.common import col, pieces_for, table
from farelane.session import materialize

CAPACITY = 4096
END_ID = 2
WINDOWS_A_GROUP = 256
PIECES_A_GROUP = 4096
#: What a document has beyond full windows is cut into pieces of this length: small pieces balance well.
TAIL_PIECE = 1024

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, place bigint"


def document_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                    capacity: int = CAPACITY, end_id: int = END_ID, tail: int = TAIL_PIECE) -> DataFrame:
    """Pieces of every encoded document, with the CRC-32 of their little-endian 32-bit ids."""
    path = tokenizer or word_tokens.tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        try:
            for b in batches:
                out = []
                for i, ids in word_tokens.token_ids(b.column(1), path, end_id):
                    data = memoryview(ids.astype("<u4")).cast("B")
                    full = len(ids) - len(ids) % capacity
                    for at in [*range(0, full, capacity), *range(full, len(ids), tail)]:
                        n = min(capacity if at < full else tail, len(ids) - at)
                        out.append((i, at, n, zlib.crc32(data[4 * at:4 * (at + n)]), len(ids), place))
                        place += 1
                rows = np.asarray(out, np.int64).reshape(-1, 6)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows[:, 0]))] + [pa.array(rows[:, k]) for k in range(1, 6)],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"])
        finally:
            word_tokens.forget()

    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


def differencing(sizes, ways: int) -> np.ndarray:
    """The slot (0 to ways - 1) of each size, by multiway differencing."""
    sizes = np.asarray(sizes, np.int64)
    if ways == 1 or len(sizes) == 0:
        return np.zeros(len(sizes), np.int64)
    heap, merges = [], []  # merges: left node, right node, the right slot that joins each left slot, in order of the sums
    for i, s in enumerate(sizes):
        sums = np.zeros(ways, np.int64)
        sums[0] = s
        heap.append((-int(s), i, sums))
    heapq.heapify(heap)
    node = len(sizes)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)  # sums in falling order
        _, b, y = heapq.heappop(heap)
        both = x + y[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(both[0] - both[-1]), node, both))
        node += 1
    # from the last merge down: the final slot of each slot of each node
    final = {node - 1: np.arange(ways)}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        place = np.empty(ways, np.int64)
        place[order] = final.pop(len(sizes) + k)  # by slot of the left node
        final[a], final[b] = place, place[::-1]
    return np.asarray([final[i][0] for i in range(len(sizes))], np.int64)


def near_equal_windows(sizes, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each size; no window exceeds ``capacity``, and no size may."""
    sizes = np.asarray(sizes, np.int64)
    ways = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        slots = differencing(sizes, ways)
        if np.bincount(slots, sizes, ways).max() <= capacity:
            return slots
        ways += 1


def pack(pieces: DataFrame, capacity: int = CAPACITY, windows_a_group: int = WINDOWS_A_GROUP, pieces_a_group: int = PIECES_A_GROUP) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (see ``document_pieces``)."""
    pieces = materialize(pieces)
    total = pieces.agg(F.sum("length").alias("tokens"), F.count("*").alias("n")).first()
    groups = max(pieces_for(total.tokens, capacity * windows_a_group), pieces_for(total.n, pieces_a_group))
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "place"), F.lit(groups)))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(key, t):
        df = t.to_pandas().sort_values(["start", "doc_id", "ids_crc32", "place"], kind="stable")
        size = df["length"].to_numpy()
        part = size < capacity
        slot = np.empty(len(df), np.int64)
        slot[part] = near_equal_windows(size[part], capacity)
        windows = int(slot[part].max()) + 1 if part.any() else 0
        slot[~part] = windows + np.arange(int((~part).sum()))
        order = np.argsort(slot, kind="stable")
        df, slot, size = df.iloc[order], slot[order], size[order]
        ends = np.cumsum(size)
        first = np.concatenate([[True], slot[1:] != slot[:-1]])
        base = np.maximum.accumulate(np.where(first, ends - size, 0))
        ids = pa.Table.from_pandas(df[["start", "length", "ids_crc32", "doc_tokens"]].astype("int64"), preserve_index=False)
        doc_id = t.column("doc_id").take(pa.array(df.index.to_numpy()))
        return pa.table([doc_id] + [ids.column(k) for k in range(4)] + [pa.array(key[0].as_py() * (1 << 32) + slot), pa.array(ends - size - base)], names)

    return dealt.groupBy("pack_group").applyInArrow(run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(document_pieces(docs, id_col, text_col, tokenizer, capacity, end_id), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every piece of documents with its place in a sequence."""
    return pack_documents(table(spark, sf_dir, "documents"))
