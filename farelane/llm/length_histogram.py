"""Exact histogram of encoded lengths, with suffix sums for every context limit (operator 1).

One pass encodes documents and adds up, inside each task, how many have each
length; the shuffle carries (length, documents) pairs only. Suffix sums are
taken in two steps, over ranges of lengths and then inside a range, so that no
task holds all lengths however many there are.

A row of length n holds for every context limit L with previous length < L <= n:
``docs_at_least`` documents have L tokens or more, and texts cut to L tokens
keep ``tokens_below + L * docs_at_least`` tokens in all. ``answer_limits`` and
``quantiles`` read such answers off the histogram.

Defined results: null and empty texts have length 0; repeated rows count each
time; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelane.llm import word_tokens
from farelane.llm.common import col, table
from farelane.session import materialize

LENGTHS_A_RANGE = 1024


def document_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every document."""
    path = tokenizer or word_tokens.tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(word_tokens.token_counts(b.column(1), path), pa.int64())], ["doc_id", "n_tokens"])
        finally:
            word_tokens.forget()

    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint")


def length_counts(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(n_tokens, docs): documents of each encoded length, added up inside tasks first."""
    path = tokenizer or word_tokens.tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for b in batches:
                n, c = np.unique(word_tokens.token_counts(b.column(0), path), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(c, pa.int64())], ["n_tokens", "docs"])
        finally:
            word_tokens.forget()

    parts = docs.select(col(text_col).cast("string").alias("text")).mapInArrow(run, "n_tokens bigint, docs bigint")
    return parts.groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def length_histogram(counts: DataFrame, lengths_a_range: int = LENGTHS_A_RANGE) -> DataFrame:
    """(n_tokens, docs) with prefix and suffix sums.

    Adds prev_length (the next shorter length, -1 at the start), docs_at_least,
    tokens_at_least, tokens_below, kept_tokens (all tokens when texts are cut
    to this length), and share (documents up to this length, of all).
    """
    counts = materialize(counts.select("n_tokens", "docs").withColumn("part", F.floor(F.col("n_tokens") / lengths_a_range)))
    parts = counts.groupBy("part").agg(F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("n_tokens")).alias("t"), F.max("n_tokens").alias("longest"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    starts = parts.select("part", F.coalesce(F.sum("d").over(earlier), F.lit(0)).alias("d0"), F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t0"),
                          F.coalesce(F.max("longest").over(earlier), F.lit(-1)).alias("p0"),
                          F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"))
    inside = Window.partitionBy("part").orderBy("n_tokens")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.join(starts, "part")
    docs_below = F.col("d0") + F.coalesce(F.sum("docs").over(before), F.lit(0))
    tokens_below = F.col("t0") + F.coalesce(F.sum(F.col("docs") * F.col("n_tokens")).over(before), F.lit(0))
    rows = rows.select("n_tokens", "docs", F.coalesce(F.lag("n_tokens").over(inside), F.col("p0")).alias("prev_length"),
                       docs_below.alias("docs_below"), tokens_below.alias("tokens_below"), "all_docs", "all_tokens")
    return rows.select("n_tokens", "prev_length", "docs", (F.col("all_docs") - F.col("docs_below")).alias("docs_at_least"),
                       (F.col("all_tokens") - F.col("tokens_below")).alias("tokens_at_least"), "tokens_below",
                       (F.col("tokens_below") + F.col("n_tokens") * (F.col("all_docs") - F.col("docs_below"))).alias("kept_tokens"),
                       ((F.col("docs_below") + F.col("docs")) / F.col("all_docs")).alias("share"), "all_docs", "all_tokens")


def answer_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_at_least, docs_cut, kept_tokens, lost_tokens) for each context limit asked for."""
    at = F.explode(F.filter(F.array(*[F.lit(int(x)).cast("bigint") for x in limits]), lambda x: (x > F.col("prev_length")) & (x <= F.col("n_tokens"))))
    found = histogram.withColumn("limit", at).select(
        "limit", "docs_at_least", (F.col("docs_at_least") - F.when(F.col("limit") == F.col("n_tokens"), F.col("docs")).otherwise(0)).alias("docs_cut"),
        (F.col("tokens_below") + F.col("limit") * F.col("docs_at_least")).alias("kept_tokens"), "all_tokens")
    # limits above every length cut nothing
    top = histogram.agg(F.max("n_tokens").alias("longest"), F.max("all_tokens").alias("all_tokens"))
    above = top.withColumn("limit", F.explode(F.array(*[F.lit(int(x)).cast("bigint") for x in limits]))).where("`limit` > longest")
    above = above.select("limit", F.lit(0).cast("bigint").alias("docs_at_least"), F.lit(0).cast("bigint").alias("docs_cut"), F.col("all_tokens").alias("kept_tokens"), "all_tokens")
    return found.unionByName(above).withColumn("lost_tokens", F.col("all_tokens") - F.col("kept_tokens")).drop("all_tokens")


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share_asked, n_tokens): the smallest length that at least this share of all documents does not exceed."""
    asked = F.explode(F.array(*[F.lit(float(x)) for x in shares]))
    rows = histogram.select("n_tokens", "share", asked.alias("share_asked")).where("share >= share_asked")
    return rows.groupBy("share_asked").agg(F.min("n_tokens").alias("n_tokens"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: the whole histogram of documents."""
    return length_histogram(length_counts(table(spark, sf_dir, "documents")))
