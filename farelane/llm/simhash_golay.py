"""SimHash near-duplicates found through Golay-code fuzzy keys (operator 10).

A text's fingerprint is the majority of the 64-bit hashes of its word
shingles. It is cut into three segments of 23, 23 and 18 bits. The binary
Golay code of length 23 is perfect: every 23-bit word decodes to one of 4096
codewords, so the codewords that a segment and its one-bit neighbours decode
to (one or six of them) are shared by any two segments at most two bits apart,
since those have a common neighbour.

With two differing bits at most, one of three segments has none (pigeonhole),
and the segment after it has at most two. A key is therefore a segment's exact
bits with one codeword of the next segment: up to 18 keys, of which any two
fingerprints that must be linked share one. Fingerprints are joined on their
keys, and each pair that the join makes is verified by its bit distance.

A key that more than ``MAX_GROUP`` fingerprints share would make too many
pairs. Its members link without pairs: each gives its 64 one-bit neighbours and
itself, and those that meet in one word (65 at most can) are two bits apart at
most, while any two that close do meet. In each meeting all hang on the
smallest. So no group is paired out, and no link is lost.

Work is done on distinct fingerprints: copies, however many, are one.

Defined results: null and empty texts have fingerprint zero, linked like any
other; one or two words are a single shingle; null ids are ignored when the
smallest id of a component is taken (null if it has no other); repeated rows
each keep their row; an empty table gives no rows. Extra columns are ignored
by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelane.llm.common import col, table, whole_text
from farelane.llm.components import components
from farelane.session import materialize

SHINGLE = 3
MAX_BITS = 2
#: Most fingerprints of a key that are paired; larger groups meet in neighbouring words.
MAX_GROUP = 64
SEED = 42
#: Bytes of a text that are split into words at a time.
BLOCK = 1 << 20
# Generator polynomial of the binary Golay code of length 23, and the segments of a fingerprint (offset, bits).
GOLAY_GENERATOR = 0xC75
SEGMENTS = ((0, 23), (23, 23), (46, 18))

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words, a bounded block at a time."""
    at = 0
    while at < len(data):
        m = _SPACE.search(data, at + BLOCK)
        end = m.end() if m else len(data)
        yield data[at:end].lower().split()  # of bytes: ASCII letters and ASCII white space only
        at = end


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text."""
    h = partial(xxhash.xxh64_intdigest, seed=SEED)
    ones, n, carry = np.zeros(64, np.int64), 0, []
    for block in _word_blocks(data):
        words = carry + block
        if len(words) < shingle:
            carry = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - [len(w) + 1 for w in words]).tolist()
        hashes = np.array([h(joined[a:b]) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())], np.uint64)
        for k in range(0, len(hashes), 65536):
            ones += np.unpackbits(hashes[k:k + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
        carry = words[len(words) - shingle + 1:]
    if n == 0:
        return h(b" ".join(carry)) if carry else 0
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every document; fp holds the fingerprint's bits in a signed long, text_hash tells texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x.as_buffer().to_pybytes(), shingle) for x in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_hash", "fp"])
            pa.default_memory_pool().release_unused()

    text = whole_text(text_col)
    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def golay_table() -> np.ndarray:
    """The number (0 to 4095) of the codeword that each 23-bit word decodes to; computed once a task."""
    words = np.arange(4096, dtype=np.int64) << 11
    rest = words.copy()
    for bit in range(22, 10, -1):  # remainder by the generator
        rest ^= np.where(rest >> bit & 1, GOLAY_GENERATOR << (bit - 11), 0)
    words |= rest
    out = np.empty(1 << 23, np.int16)
    errors = [0] + [1 << i for i in range(23)] + [1 << i | 1 << j for i in range(23) for j in range(i)] + [
        1 << i | 1 << j | 1 << k for i in range(23) for j in range(i) for k in range(j)]
    for e in errors:
        out[words ^ e] = np.arange(4096)
    return out


def fuzzy_keys(fp: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of unsigned 64-bit fingerprints, each key of a row once; ``code`` is the table of codewords."""
    parts = [((fp >> np.uint64(o)) & np.uint64((1 << n) - 1)).astype(np.int64) for o, n in SEGMENTS]
    rows, keys = [], []
    for k, exact in enumerate(parts):
        nxt = (k + 1) % 3
        flips = np.concatenate([[0], 1 << np.arange(SEGMENTS[nxt][1])])
        codes = np.sort(code[parts[nxt][:, None] ^ flips[None, :]], axis=1)
        new = np.concatenate([np.ones((len(fp), 1), bool), codes[:, 1:] != codes[:, :-1]], axis=1)
        r, c = np.nonzero(new)
        rows.append(r)
        keys.append(np.int64(k) << 40 | exact[r] << 12 | codes[r, c].astype(np.int64))
    return np.concatenate(rows), np.concatenate(keys)


def link(fps: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """(node, root) of distinct fingerprints (fp) that lie within two bits of others, linked over any number of steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = golay_table()
        for b in batches:
            for at in range(0, b.num_rows, 20_000):
                fp = b.column(0).slice(at, 20_000).to_numpy()
                rows, keys = fuzzy_keys(fp.view(np.uint64), code)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], ["key", "fp"])

    keyed = materialize(fps.select("fp").mapInArrow(run, "key bigint, fp bigint"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # fingerprints whose key another shares: few of all, written once
    met = materialize(keyed.join(shared, "key"))
    close = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS
    some = met.where(F.col("n") <= max_group)
    pairs = some.select("key", F.col("fp").alias("a")).join(some.select("key", F.col("fp").alias("b")), "key").where((F.col("a") > F.col("b")) & close("a", "b"))
    many = met.where(F.col("n") > max_group).select("fp").distinct()
    near = many.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("bit"))
    near = near.select("fp", F.expr("IF(bit = 64, fp, fp ^ shiftleft(1L, bit))").alias("meeting"))
    hung = near.select(F.col("fp").alias("a"), F.min("fp").over(Window.partitionBy("meeting")).alias("b")).where((F.col("a") != F.col("b")) & close("a", "b"))
    return components(pairs.select("a", "b").unionByName(hung))


def near_duplicates(prints: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of ``fingerprints`` rows; root is the component's smallest fingerprint."""
    prints = materialize(prints)
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    rooted = distinct.join(link(distinct).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialize(rooted)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(ids, "root").select("fp", "root", "component_id"), "fp", "left")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, that with the smallest id, with the columns of ``docs``."""
    found = near_duplicates(fingerprints(docs, id_col, text_col, shingle))
    named = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    # components of null ids only are told apart by their root
    group = F.when(F.col("component_id").isNull(), F.col("root"))
    first = found.groupBy("component_id", group.alias("g")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"))
    first = first.select(named(F.col("first.doc_id")).alias("keep_id"), F.col("first.text_hash").alias("keep_hash"))
    row = F.struct(*[col(c) for c in docs.columns]).alias("row")
    rows = docs.select(named(col(id_col).cast("bigint")).alias("keep_id"), F.xxhash64(whole_text(text_col)).alias("keep_hash"), row)
    kept = rows.join(first, ["keep_id", "keep_hash"], "left_semi").dropDuplicates(["keep_id", "keep_hash"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: fingerprint and component of every document."""
    found = near_duplicates(fingerprints(table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
