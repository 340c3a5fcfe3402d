"""Mixing sources to target weights, DataFrame functions only (operator 6).

Each document gets a hash-random key. Within its source the keys are ranged
into buckets and sorted; prefix sums of the token counts are computed in two
steps (bucket totals, then rows inside a bucket), and a source is cut at
exactly its budget. A budget above the source's size repeats whole epochs and
cuts the last one.

A key is the MD5 of seed, document id and text, so it is uniform, with
repeated or missing ids too: equal key ranges hold equal shares of a source. The bucket count follows the document count,
which splits a source that holds a third of all rows over as many tasks as any
other rows; one task never sorts a whole source. Only per-source rows (one for
each distinct source) meet in one window, which ranks them by code point.

Defined results: null text has size 0; null source is a source of its own,
last in order; documents without id, or with one id, are told apart by their
texts; repeated rows share a key and are separate documents; an empty table gives no rows; sources of
size 0 get target 0. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelane.llm.common import WORD_PATTERN, col, once, pieces_for, table, whole_text
from farelane.session import join_small, materialize

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
ROWS_A_BUCKET = 4096


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of (source, source_size): weights by code-point order, water-filled under ``max_epochs`` times the size.

    With sources in order of cap over weight, the level at a source is what is
    left after the sources before it took their caps, per unit of the weight
    that is left. The first source whose cap does not lie below its level sets
    the level for all: a target is the smaller of cap and level times weight.
    That is the fixed point of resharing any excess by weight.
    """
    every, by_name = Window.partitionBy(), Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("rank"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    left = F.sum("source_size").over(every).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    return (sizes.withColumn("rank", F.row_number().over(by_name) - 1)
            .withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
            .withColumn("level", left / F.sum("weight").over(onward))
            .withColumn("pos", F.row_number().over(by_cap))
            .withColumn("set", F.min(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct("pos", "level"))).over(every))
            .select("source", "source_size", F.least(F.col("cap"), F.col("set.level") * F.col("weight")).alias("target")))


def sized_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, text_hash, size) with size the number of words."""
    return docs.select(col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"), F.md5(whole_text(text_col)).alias("text_hash"),
                       F.regexp_count(whole_text(text_col), F.lit(WORD_PATTERN)).cast("bigint").alias("size"))


def mix_sources(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
                rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    """Take each source to its target: ``sized`` has doc_id, source, text_hash, size and may carry a ``row`` column.

    Adds source_size, target and taken (words taken, repeats counted); a
    source's taken words sum to its target in whole words. ``sized`` is read
    three times, so pass a materialized or cheap frame. Only rows of the one
    bucket that a source is cut in are moved; other buckets are taken or left
    whole where they lie.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("text_hash")))
    buckets = pieces_for(sized.count(), rows_a_bucket)
    bucket = F.floor(F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("double") * buckets / float(1 << 32)).cast("bigint")
    named = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    keyed = sized.withColumn("mix_key", key).withColumn("mix_bucket", bucket).withColumn("mix_source", named)

    totals = materialize(keyed.groupBy("mix_source", "source", "mix_bucket").agg(F.sum("size").alias("bucket_size")))
    targets = source_targets(totals.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_epochs)
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    targets = (targets.withColumn("mix_source", named).drop("source")
               .withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size")))
    upto = Window.partitionBy("mix_source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut_here = F.col("bucket_end") > F.col("rest")
    cuts = (totals.withColumn("bucket_end", F.sum("bucket_size").over(upto)).join(targets, "mix_source")
            .groupBy("mix_source", "source_size", "target", "epochs", "rest")
            .agg(F.min(F.when(cut_here, F.struct("mix_bucket", (F.col("bucket_end") - F.col("bucket_size")).alias("start")))).alias("cut"))
            .select("mix_source", "source_size", "target", "epochs", "rest",
                    F.coalesce(F.col("cut.mix_bucket"), F.lit(buckets).cast("bigint")).alias("cut_bucket"), F.col("cut.start").alias("cut_start")))

    placed = join_small(keyed, materialize(cuts), "mix_source")
    whole = placed.where("mix_bucket <> cut_bucket").withColumn("part", F.expr("IF(mix_bucket < cut_bucket, size, 0L)"))
    inside = Window.partitionBy("mix_source").orderBy("mix_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("cut_start") + F.sum("size").over(inside) - F.col("size")
    cut = placed.where("mix_bucket = cut_bucket").withColumn("part", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), F.col("rest") - start)))
    return whole.unionByName(cut).select(*sized.columns, "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
                    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document once for each epoch it is taken in, its last copy cut to the words taken.

    A cut text ends after its last word taken, and its ``n_chars``, where
    there is such a column, follows. Documents without words cost no budget
    and stay once.
    """
    # the row travels as one struct, so that no column of the input can clash
    sized = docs.select(col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"), once(F.md5(whole_text(text_col))).alias("text_hash"),
                        once(F.regexp_count(whole_text(text_col), F.lit(WORD_PATTERN)).cast("bigint")).alias("size"),
                        F.struct(*[col(c) for c in docs.columns]).alias("row"))
    mixed = mix_sources(sized, weights, max_epochs, seed).where("taken > 0 OR size = 0")
    mixed = mixed.withColumn("times", F.expr("CAST(IF(size > 0, taken DIV size, 1) AS INT)"))
    mixed = mixed.withColumn("over", F.expr("CAST(IF(size > 0, taken - times * size, 0) AS INT)"))
    # -1: the whole text; else the words that the cut copy holds
    copies = F.concat(F.array_repeat(F.lit(-1), F.col("times")), F.expr("IF(over > 0, array(over), CAST(array() AS ARRAY<INT>))"))
    out = mixed.select("row", F.explode(copies).alias("words"))
    up_to = F.regexp_extract_all(F.col("row").getField(text_col), F.lit(r"[\x20\x09-\x0D]*" + WORD_PATTERN), F.lit(0))
    cut = F.array_join(F.slice(up_to, F.lit(1), F.greatest(F.col("words"), F.lit(1))), "")
    is_cut = F.col("words") >= 0
    new = {text_col: F.when(is_cut, cut).otherwise(F.col("row").getField(text_col))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(is_cut, F.length(cut)).otherwise(F.col("row").getField("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: what the mix takes of every document."""
    mixed = mix_sources(materialize(sized_documents(table(spark, sf_dir, "documents"))))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}')) AS BIGINT) AS size,
         md5(concat('{SEED}:', coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', md5(coalesce(text, '')))) AS mix_key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM s),
w AS (SELECT *, CAST([1, 2, 3][rnk % 3 + 1] AS DOUBLE) AS weight, source_size * CAST(3 AS DOUBLE) AS cap FROM r),
l AS (
  SELECT *, row_number() OVER o AS pos,
         (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM w WINDOW o AS (ORDER BY cap / weight, rnk)),
f AS (SELECT lvl FROM l WHERE NOT cap / weight < lvl ORDER BY pos LIMIT 1),
t AS (SELECT source, source_size, least(cap, f.lvl * weight) AS target FROM l, f),
b AS (SELECT *, CAST(round(target) AS BIGINT) AS budget FROM t),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
p AS (
  SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY mix_key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM d)
SELECT p.doc_id, p.size, e.source_size, e.target,
       CAST(e.epochs * p.size + greatest(0, least(p.size, e.budget - e.epochs * e.source_size - p.start)) AS BIGINT) AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source
"""
