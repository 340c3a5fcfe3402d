"""A corpus pipeline over the operators of ``farelane.llm``.

``STAGES`` are applied to ``documents`` in order; each stage's rows are written
as Parquet under the shared checkpoint folder and read again as the next
stage's documents, so a lost executor costs a stage's re-read and no stage is
computed twice. All but the last stage return the columns of ``documents``.

1. quality rules: rejected documents go, failed lines are cut out;
2. SimHash near-dedup: one document of each group stays, that with the smallest id;
3. secret scans: every span found is replaced by a mark;
4. mixing: sources reach their target weights, by whole epochs and an exact cut;
5. packing: near-equal windows of 4096 tokens, one row for each piece.

Null texts fail the quality rules and go; null ids and sources pass through;
repeated rows count as near copies of each other, so one stays until the mix
repeats it; an empty table gives no rows at any stage. Extra columns are kept
up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelane.llm import line_quality, secret_scan, simhash_golay, source_mix, window_packing
from farelane.llm.common import table
from farelane.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failed lines."""
    return line_quality.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_golay.keep_one(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced."""
    return secret_scan.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source taken to its target: documents repeat by epochs, the last copy at a source's budget is cut."""
    return source_mix.mixed_documents(docs)


def window_packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents and their places in sequences."""
    return window_packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("secret_redaction", secret_redaction),
    ("source_mixing", source_mixing),
    ("window_packs", window_packs),
]

#: Markov models, tokenizers and components are beyond SQL; tests hold each stage, on its own input, against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
