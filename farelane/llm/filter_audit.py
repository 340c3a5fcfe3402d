"""Filter interaction audit over a sparse document-term matrix (operator 12).

Which of five quality filters removes a document depends on their order. The
texts become a sparse matrix of documents x words first: each task cuts its
rows into shards of bounded size and counts the words of each document against
the shard's own word list; the lists meet in one global dictionary, whose
numbers replace the local ones. A shard is then a matrix in CSR form (row
starts, column numbers, counts). A row's sum is the document's words, its
nonzero count the distinct ones, and these decide two filters:

* A: under ``min_words`` words;
* B: distinct words under ``min_distinct_percent`` of the words.

The others are attached: C (too many capitals), D (a symbol of ``#$%&*|``) and
E (the text of a smaller doc_id, found by SHA-256 over the whole table). Each
document is then a mask of failed filters, counted by part, mask and label.
From these counts follows, for each set S of filters, how many documents fail
none of S; every order, step and Shapley sum reads only that table of 32 sets
a part, so the audit of all orders costs the same whatever the input.

Rows travel as masks and digests only. Repeated rows are added up inside each
task before any shuffle; a text's smallest id joins back on digest and id, so a
group of copies, however large, is spread by its ids. A shard holds at most
``shard_bytes`` of text, or one longer text. Shards and masks are written under
the shared folder, so a lost executor costs a re-read.

Defined results: null and empty texts have no words and are one text; a null
lang is the part ``''``, as an empty lang is; a null id has no smaller one, is
none itself and has no label; of repeated ids none is smaller than the other; a document is good
or toxic if any label row of its id says 1; an empty table gives no rows. Texts
have no length limit. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import SPACE_CLASS, WORD_PATTERN, col, keep, table, whole_text

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SHARD_BYTES = 8 << 20
#: |S|! (4 - |S|)!: the orders in which exactly the filters of S come before a given one.
ORDERS_BEFORE = (24, 6, 4, 6, 24)

# Bytes of capitals, of the symbols of filter D, and those that continue a UTF-8 code point.
CAPITALS = bytes(range(0x41, 0x5B))
SYMBOLS = b"#$%&*|"
CONTINUATION = bytes(range(0x80, 0xC0))

SHARD_SCHEMA = ("shard bigint, doc_id array<bigint>, part array<string>, flags array<int>, digest array<binary>, "
                "starts binary, term binary, n binary, words array<binary>")
CODEC = "zstd"


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers under 2^31 as a compressed frame behind its length."""
    raw = numbers.astype("<i4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, CODEC, asbytes=True)


def _unpacked(frame: pa.Scalar) -> np.ndarray:
    data = frame.as_buffer()
    return np.frombuffer(pa.decompress(data.slice(8), int.from_bytes(data.slice(0, 8).to_pybytes(), "little"), CODEC), "<i4")


def _flags(text: bytes, max_capital_percent: int) -> int:
    """Filters C and D as mask bits."""
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, CONTINUATION))
    return 4 * (100 * capitals > max_capital_percent * points) + 8 * (len(text.translate(None, SYMBOLS)) < len(text))


def _shard(number: int, ids: pa.Array, parts: pa.Array, texts: pa.Array, max_capital_percent: int) -> pa.RecordBatch:
    """One row: a CSR matrix of the texts over the shard's own words, and what else is known of each document."""
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    real = pc.not_equal(pc.binary_length(words), 0)  # white space at either end leaves an empty piece
    coded = words.filter(real).dictionary_encode()
    ends = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[split.offsets.to_numpy() - split.offsets[0].as_py()]
    row = np.repeat(np.arange(len(texts)), np.diff(ends))
    width = max(1, len(coded.dictionary))
    cell, n = np.unique(row * width + coded.indices.to_numpy(), return_counts=True)
    starts = np.concatenate([[0], np.cumsum(np.bincount(cell // width, minlength=len(texts)))])
    raw = [t.as_buffer().to_pybytes() for t in texts]
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    term = cell % width
    return pa.record_batch([
        pa.array([number]), one(ids, pa.int64()), one(parts, pa.string()), one([_flags(t, max_capital_percent) for t in raw], pa.int32()),
        one([hashlib.sha256(t).digest() for t in raw], pa.binary()), pa.array([_packed(starts)]), pa.array([_packed(np.diff(term, prepend=0))]),
        pa.array([_packed(n)]), one(coded.dictionary.cast(pa.binary()), pa.binary())],
        ["shard", "doc_id", "part", "flags", "digest", "starts", "term", "n", "words"])


def local_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", shard_bytes: int = SHARD_BYTES,
                 max_capital_percent: int = MAX_CAPITAL_PERCENT) -> DataFrame:
    """One row per shard of documents, words numbered by the shard's own list; ``starts``, ``n`` and the steps of ``term`` are packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for b in batches:
            texts = b.column(2).cast(pa.large_binary()).cast(pa.large_string())
            ends, at = np.cumsum(pc.binary_length(texts).to_numpy()), 0
            while at < b.num_rows:
                before = int(ends[at - 1]) if at else 0
                n = max(1, int(np.searchsorted(ends, before + shard_bytes, "right")) - at)
                yield _shard(number, b.column(0).slice(at, n), b.column(1).slice(at, n), texts.slice(at, n), max_capital_percent)
                number, at = number + 1, at + n
            pa.default_memory_pool().release_unused()

    part = F.coalesce(col(part_col).cast("string"), F.lit(""))
    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), part.alias("part"), whole_text(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, SHARD_SCHEMA)


def numbered(shards: DataFrame) -> DataFrame:
    """(word, shard, at, id): each shard's words and the global number of each.

    Equal words meet in one partition, sorted, and a partition counts its
    distinct words. Number of partitions, order and so the numbers are the same
    in every run. A word has a row per shard at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, last = (TaskContext.get().partitionId() << 32) - 1, None
        for b in batches:
            if not b.num_rows:
                continue
            words = b.column(0)
            new = np.ones(b.num_rows, bool)
            new[0] = words[0].as_py() != last
            new[1:] = pc.not_equal(words.slice(1), words.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
            ids = number + np.cumsum(new)
            number, last = int(ids[-1]), words[-1].as_py()
            yield pa.record_batch([*b.columns, pa.array(ids)], ["word", "shard", "at", "id"])

    partitions = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = shards.select("shard", F.posexplode("words").alias("at", "word")).select("word", "shard", "at")
    return entries.repartition(partitions, "word").sortWithinPartitions("word").mapInArrow(run, "word binary, shard bigint, at int, id bigint")


def dictionary(numbers: DataFrame) -> DataFrame:
    """(word, id): every distinct word once."""
    return numbers.groupBy("word").agg(F.first("id").alias("id"))


def _csr(shard: pa.Table, numbers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row starts, global column numbers and counts of a shard."""
    ids = np.full(numbers.num_rows, -1)
    ids[numbers.column("at").to_numpy()] = numbers.column("id").to_numpy()
    assert (ids >= 0).all(), "a word without its number"
    starts, step, n = (_unpacked(shard.column(c)[0]) for c in ("starts", "term", "n"))
    return starts, ids[np.cumsum(step, dtype=np.int64)], n


def _meet(shards: DataFrame, numbers: DataFrame, run, schema: str) -> DataFrame:
    """Each shard with the numbers of its own words, which its text bounds."""
    left = shards.drop("words").groupBy("shard")
    return left.cogroup(numbers.select("shard", "at", "id").groupBy("shard")).applyInArrow(run, schema)


def csr_shards(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """(shard, doc_id, starts, terms, n): the matrix over the global dictionary, a row per shard."""

    def run(_, shard: pa.Table, numbers: pa.Table) -> pa.Table:
        starts, terms, n = _csr(shard, numbers)
        return pa.table([shard.column("shard"), shard.column("doc_id"), pa.array([starts], pa.list_(pa.int32())), pa.array([terms], pa.list_(pa.int64())),
                         pa.array([n], pa.list_(pa.int32()))], ["shard", "doc_id", "starts", "terms", "n"])

    return _meet(shards, numbers, run, "shard bigint, doc_id array<bigint>, starts array<int>, terms array<bigint>, n array<int>")


def decide(shards: DataFrame, numbers: DataFrame, min_words: int = MIN_WORDS, min_distinct_percent: int = MIN_DISTINCT_PERCENT) -> DataFrame:
    """(doc_id, part, digest, mask, n_words, n_distinct) of every document, from its row of the matrix: A is bit 1 of the mask, B 2, C 4, D 8."""

    def run(_, shard: pa.Table, numbers: pa.Table) -> pa.Table:
        starts, terms, n = _csr(shard, numbers)
        row_sum = np.diff(np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[starts])
        nonzero = np.diff(starts).astype(np.int64)
        ids, part, flags, digest = (shard.column(c)[0].values for c in ("doc_id", "part", "flags", "digest"))
        mask = flags.to_numpy() | 1 * (row_sum < min_words) | 2 * (100 * nonzero < min_distinct_percent * row_sum)
        return pa.table([ids, part, digest, pa.array(mask, pa.int32()), pa.array(row_sum), pa.array(nonzero)],
                        ["doc_id", "part", "digest", "mask", "n_words", "n_distinct"])

    return _meet(shards, numbers, run, "doc_id bigint, part string, digest binary, mask int, n_words bigint, n_distinct bigint")


def count_masks(decided: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, good, toxic, n): documents by failed filters, E (bit 16) included, and by label."""
    decided = keep(decided.select("doc_id", "part", "digest", "mask"))
    rows = decided.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    first = decided.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    says = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c)
    known = labels.where(col(id_col).isNotNull()).groupBy(col(id_col).cast("bigint").alias("doc_id")).agg(says("quality"), says("toxic"))
    with_id = rows.where("doc_id IS NOT NULL").join(first, ["digest", "doc_id"], "left").join(known, "doc_id", "left")
    without = rows.where("doc_id IS NULL").withColumns({"first": F.lit(True), "quality": F.lit(0), "toxic": F.lit(0)})
    every = with_id.select(*without.columns).unionByName(without)
    with_e = F.col("mask").bitwiseOR(F.when(F.col("first"), 0).otherwise(16)).alias("mask")
    return every.groupBy("part", with_e, F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(F.sum("n").alias("n"))


def audit(masks: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of ``count_masks`` rows."""
    free = "IF(mask & s = 0, n, 0L)"
    sets = masks.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(31)))).groupBy("part", "s").agg(
        F.sum(F.expr(free)).alias("k"), F.sum(F.expr(f"{free} * good")).alias("g"), F.sum(F.expr(f"{free} * toxic")).alias("t"))
    parts = sets.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("s", "k", "g", "t"))).alias("a"))
    parts = parts.select("part", F.col("a.k").alias("k"), F.col("a.g").alias("g"), F.col("a.t").alias("t"))
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(FILTERS))), ",")
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    before = " + ".join(f"IF(instr(substring(filter_order, 1, step - 1), '{c}') > 0, {1 << i}, 0)" for i, c in enumerate(FILTERS))
    steps = steps.withColumns({"b": F.expr(before), "f": F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, step, 1)) - 1)")})
    weight = f"array({', '.join(f'{w}L' for w in ORDERS_BEFORE)})"
    shapley = f"aggregate(sequence(0, 31), 0L, (x, s) -> x + IF(s & f = 0, {weight}[bit_count(s)] * (k[s] - k[s | f]), 0L))"
    # k[s]: documents that fail no filter of the set s
    return steps.selectExpr(
        "part", "filter_order", "step", "k[b | f] AS kept", "k[b] - k[b | f] AS removed", "(k[0] - k[f]) - (k[b] - k[b | f]) AS redundant",
        "k[31 - f] - k[31] AS unique_fails", "g[b] - g[b | f] AS good_lost", "t[b] - t[b | f] AS toxic_lost", f"{shapley} AS shapley")


def interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", shard_bytes: int = SHARD_BYTES,
                 min_words: int = MIN_WORDS, min_distinct_percent: int = MIN_DISTINCT_PERCENT, max_capital_percent: int = MAX_CAPITAL_PERCENT) -> DataFrame:
    """The audit of all orders of the five filters over whole texts."""
    shards = keep(local_shards(docs, id_col, text_col, part_col, shard_bytes, max_capital_percent), "zstd")
    decided = decide(shards, numbered(shards), min_words, min_distinct_percent)
    return audit(count_masks(decided, labels, id_col))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every part, order and step."""
    return interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}') AS words FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(words) < {MIN_WORDS} AS a, 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MAX_CAPITAL_PERCENT} * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d, coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), FALSE) AS e
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
m AS (
  SELECT part, good, toxic, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
         || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails, count(*) AS n
  FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
w AS (SELECT filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS earlier
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
y AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter, n, good, toxic, contains(fails, filter) AS failing, fails = filter AS only_this,
         earlier <> '' AND len(list_intersect(string_split(fails, ''), string_split(earlier, ''))) > 0 AS gone
  FROM m, w),
z AS (
  SELECT part, filter_order, step, any_value(filter) AS filter, CAST(sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN only_this THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN NOT gone AND failing THEN n * good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN NOT gone AND failing THEN n * toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM y GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM z
"""
