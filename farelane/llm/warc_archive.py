"""WARC records in a content-addressed archive (operator 5).

An archive is a folder with two Parquet tables:

* ``payloads`` (digest, payload_bytes, payload): every distinct payload once,
  addressed by its SHA-256;
* ``headers`` (record_no, digest, header): each record's exact header bytes,
  without its block.

Records are reconstructed by joining the two on the digest: a response is its
header followed by the stored payload, a revisit is a header that names the
response and, through the digest, the same stored payload. Reading recomputes
the digest of each stored payload, so a damaged or colliding payload shows as
``verified = false`` instead of passing as the original.

Defined results: null html is an empty payload; a null url leaves out the
target header; a null page id is written as ``null`` and read back as null,
ordered after all ids; of repeated rows (same id, same payload) exactly one is
the response; payloads under ``min_bytes`` are always responses but are still
stored once; empty pages give empty tables. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import col, table
from farelane.session import scratch_path

MIN_REVISIT_BYTES = 100
# Fixed values of the WARC 1.1 format.
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
#: The records' date: a parameter, so that reruns write the same bytes.
WARC_DATE = "2024-01-01T00:00:00Z"


def _header(date: str):
    """The header text of a record from its columns; url control characters are percent-encoded."""
    is_response = F.col("record_type") == "response"
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit(WARC_VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), page(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),  # null url: null, left out by concat_ws
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(~is_response, F.concat(F.lit("WARC-Refers-To: "), page(F.col("refers_to")))),
        F.when(~is_response, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(is_response, F.col("payload_bytes")).otherwise(F.lit(0)).cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES, date: str = WARC_DATE) -> None:
    """Write ``pages`` as an archive under ``path`` (``payloads``, ``headers`` and the run's ``index``).

    Payload bytes cross one shuffle, after equal ones are merged inside each
    task, so a payload that a third of the rows share moves once per task.
    Everything else moves digests only. ``index`` fixes each record's number,
    which settles ties between repeated rows however tasks are retried.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(col(id_col).cast("bigint").alias("page_id"), col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    (rows.select("digest", F.octet_length("payload").cast("bigint").alias("payload_bytes"), "payload")
     .dropDuplicates(["digest"]).write.parquet(f"{path}/payloads"))
    (rows.select(F.monotonically_increasing_id().alias("record_no"), "page_id", "url", "digest",
                 F.octet_length("payload").cast("bigint").alias("payload_bytes"))
     .write.parquet(f"{path}/index"))
    index = spark.read.parquet(f"{path}/index")
    first = (index.where(F.col("payload_bytes") >= min_bytes).groupBy("digest")
             .agg(F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "record_no")).alias("first")))
    known = index.join(first, "digest", "left")
    revisit = F.coalesce(F.col("record_no") != F.col("first.record_no"), F.lit(False))
    records = known.select("record_no", "page_id", "url", "digest", "payload_bytes",
                           F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                           F.when(revisit, F.col("first.page_id")).alias("refers_to"))
    records.select("record_no", "digest", F.encode(_header(date), "UTF-8").alias("header")).write.parquet(f"{path}/headers")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records (record_no, digest, header, record): header, block and closing blank lines, as WARC bytes.

    A revisit's block is empty, as written; its payload stays where its digest points.
    """
    headers = spark.read.parquet(f"{path}/headers").withColumn("text", F.decode("header", "UTF-8"))
    is_response = F.col("text").startswith(f"{WARC_VERSION}{CRLF}WARC-Type: response{CRLF}")
    end = F.encode(F.lit(CRLF + CRLF), "UTF-8")
    responses = (headers.where(is_response)
                 .join(spark.read.parquet(f"{path}/payloads").select("digest", "payload"), "digest", "left")
                 .select("record_no", "digest", "header", F.concat("header", "payload", end).alias("record")))
    revisits = headers.where(~is_response).select("record_no", "digest", "header", F.concat("header", end).alias("record"))
    return responses.unionByName(revisits)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Parse the reconstructed records: page_id, url, record_type, refers_to, payload_bytes, payload_digest, verified.

    ``payload_digest`` and ``payload_bytes`` of a response are computed from
    the record's own block; those of a revisit from the stored payload that
    its digest addresses. ``verified``: they equal what the header says.
    """
    field = lambda name: F.regexp_extract("text", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    page = lambda name: F.regexp_extract(field(name), r"^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda c: F.when(c != "", c).cast("bigint")
    records = (read_records(spark, path)
               .withColumn("text", F.decode("header", "UTF-8"))
               .withColumn("record_type", field("WARC-Type"))
               .withColumn("block", F.expr("substring(record, length(header) + 1, length(record) - length(header) - 4)")))
    parsed = records.select(
        "record_type", "digest", number(page("WARC-Record-ID")).alias("page_id"), number(page("WARC-Refers-To")).alias("refers_to"),
        F.when(F.col("text").contains(f"{CRLF}WARC-Target-URI: "), field("WARC-Target-URI")).alias("url"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "").alias("said"),
        field("Content-Length").cast("bigint").alias("content_length"),
        F.octet_length("block").cast("bigint").alias("block_bytes"),
        F.when(F.col("record_type") == "response", F.sha2("block", 256)).alias("block_digest"))
    responses = parsed.where("record_type = 'response'").select(
        "page_id", "url", "record_type", "refers_to", F.col("block_bytes").alias("payload_bytes"),
        F.col("block_digest").alias("payload_digest"),
        ((F.col("block_digest") == F.col("said")) & (F.col("block_bytes") == F.col("content_length"))).alias("verified"))
    stored = spark.read.parquet(f"{path}/payloads").select(
        "digest", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    revisits = parsed.where("record_type = 'revisit'").join(stored, "digest", "left").select(
        "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest",
        F.coalesce(F.col("payload_digest") == F.col("said"), F.lit(False)).alias("verified"))
    return responses.unionByName(revisits)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: archive every page, read the archive back, one row per page."""
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


ORACLE = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY 1)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN f.first_id IS NOT NULL AND f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id IS NOT NULL AND f.first_id <> p.page_id THEN f.first_id END AS refers_to,
       TRUE AS verified
FROM p LEFT JOIN f USING (payload_digest)
"""
