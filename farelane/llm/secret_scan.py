"""Secret scans with character Markov models, DataFrame functions only (operator 9).

Three fixed patterns find certain secrets. Their matches also label training
samples: matched values are random strings, all other runs of identifier
characters are ordinary. Two first-order character models are counted from
them, and every long run of a text is judged by the log-likelihood ratio of
the two. Runs that look random are added as spans of kind ``markov``; spans of
the patterns always stay.

The models are fitted on a hash sample of about ``train_docs`` documents
(all of them, where there are fewer); counts of 128 x 128 character pairs at
most come to the driver, whatever the input. Texts stay in their rows: one
scan, no shuffle but that of the counts.

Defined results: null and empty texts have no spans; positions are code
points, end exclusive; repeated rows are scanned alike; an empty table gives
no rows, and a sample without secrets leaves the random model uniform. Extra
columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import col, let, pieces_for, running, table, whole_text

# The patterns, what each must reach, and their order. \x22 and \x27 are the quotes.
KINDS = ("assign", "access", "hex", "markov")
# The lookaround parts change no match: they let most positions fail at once.
ASSIGN = r"(?i)(?=[psta])(password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
MIN_VALUE = 6
# A run shorter than the least length can hold no longer one, so the length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"

RUN_CHARS = "A-Za-z0-9+/_="
RUN = rf"(?<![{RUN_CHARS}-])[{RUN_CHARS}-]{{20,}}"
ORDINARY = rf"(?<![{RUN_CHARS}-])[{RUN_CHARS}-]{{4,}}"
ALPHABET = 66
TRAIN_DOCS = 2000
#: Share of each model's mass that is uniform over the alphabet: random strings may use any character.
UNIFORM_RANDOM, UNIFORM_ORDINARY = 0.5, 0.02
#: A run is random if its ratio, in nats, exceeds both: in all and for each pair.
MIN_TOTAL, MIN_EACH = 10.0, 0.4


NO_SPANS = "CAST(array() AS ARRAY<STRUCT<s: BIGINT, k: INT, e: BIGINT, sb: BIGINT, eb: BIGINT>>)"


def _found(pattern: str, kind: int, keep: str | None = None) -> str:
    """SQL: spans (s, k, e) in code points and (sb, eb) in bytes of the pattern's matches in ``text``.

    Ends are running sums of the lengths of matches and of the pieces between
    them, so a text costs in proportion to its length. ``keep`` is an array of
    booleans, one per match, that may read the matches ``m``.
    """
    ends = lambda length: running(f"transform(m, (x, i) -> CAST({length}(x) + {length}(p[i]) AS BIGINT))", "+")
    spans = (f"transform(m, (x, i) -> struct(c[i] - length(x) AS s, {kind} AS k, c[i] AS e, b[i] - octet_length(x) AS sb, b[i] AS eb))")
    if keep:
        spans = let(keep, "good", f"filter({spans}, (x, i) -> good[i])")
    spans = let(f"split(text, r'{pattern}', -1)", "p", let(ends("length"), "c", let(ends("octet_length"), "b", spans)))
    # texts without a match stop early
    return let(f"regexp_extract_all(text, r'{pattern}', 0)", "m", f"IF(size(m) = 0, {NO_SPANS}, {spans})")


def base_spans() -> dict[str, Column]:
    """Span arrays of the three fixed patterns over column ``text``."""
    long = f"transform(regexp_extract_all(text, r'{ASSIGN}', 2), v -> length(v) >= {MIN_VALUE})"
    return {"assign": F.expr(_found(ASSIGN, 0, long)), "access": F.expr(f"IF(contains(text, 'AKIA'), {_found(ACCESS, 1)}, {NO_SPANS})"), "hex": F.expr(_found(HEX, 2))}


def _pairs(runs: str) -> str:
    """SQL: array of character pairs, as 128 * first + second, of an array of runs."""
    codes = "transform(split(r, ''), c -> ascii(c))"
    return f"flatten(transform({runs}, r -> transform(array({codes}), c -> transform(sequence(1, size(c) - 1), i -> 128 * c[i - 1] + c[i]))[0]))"


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS) -> dict[int, float]:
    """Log-likelihood ratio, random over ordinary, of each pair (128 * first + second) of run characters."""
    one_in = pieces_for(docs.count(), train_docs)
    text = whole_text(text_col)
    some = docs.where(F.pmod(F.xxhash64(col(id_col)), F.lit(one_in)) == 0).select(text.alias("text"))
    values = (f"filter(concat(regexp_extract_all(text, r'{ACCESS}', 0), regexp_extract_all(text, r'{HEX}', 0), "
              f"filter(regexp_extract_all(text, r'{ASSIGN}', 2), v -> length(v) >= {MIN_VALUE})), v -> length(v) > 1)")
    others = f"regexp_extract_all(regexp_replace(text, r'{ASSIGN}|{ACCESS}|{HEX}', ' '), r'{ORDINARY}', 0)"
    seen = some.select(F.lit(1).alias("random"), F.explode(F.expr(_pairs(values))).alias("pair")).unionByName(
        some.select(F.lit(0).alias("random"), F.explode(F.expr(_pairs(others))).alias("pair")))
    counts = {(r.random, r.pair): r.n for r in seen.where("pair < 16384").groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    rows: dict = {}
    for (kind, pair), n in counts.items():
        rows[kind, pair // 128] = rows.get((kind, pair // 128), 0) + n

    def p(kind: int, pair: int, uniform: float) -> float:
        n = rows.get((kind, pair // 128), 0)
        learned = (counts.get((kind, pair), 0) + 1 / ALPHABET) / (n + 1)
        return (1 - uniform) * learned + uniform / ALPHABET

    codes = [c for c in range(128) if re.fullmatch(f"[{RUN_CHARS}-]", chr(c))]
    return {128 * a + b: math.log(p(1, 128 * a + b, UNIFORM_RANDOM) / p(0, 128 * a + b, UNIFORM_ORDINARY)) for a in codes for b in codes}


def _markov_spans(model: dict[int, float]) -> Column:
    """Spans of long runs whose ratio says random."""
    table_ = ",".join(f"{model.get(k, 0.0):.6g}" for k in range(16384))
    ratios = f"CAST(split('{table_}', ',') AS ARRAY<DOUBLE>)"  # a constant, folded once
    codes = "transform(split(x, ''), y -> least(ascii(y), 127))"
    total = (f"aggregate({codes}, struct(-1 AS last, 0D AS sum), (a, y) -> struct(y AS last, "
             f"a.sum + IF(a.last < 0, 0D, {ratios}[greatest(128 * a.last + y, 0)]) AS sum), a -> a.sum)")
    return F.expr(_found(RUN, 3, f"transform(m, x -> {let(total, 't', f't > {MIN_TOTAL} AND t > {MIN_EACH} * (length(x) - 1)')})"))


def scan(docs: DataFrame, model: dict[int, float], id_col: str = "doc_id", text_col: str = "text", carry: Column | None = None) -> DataFrame:
    """(doc_id, text, n_assign, n_access, n_hex, spans, base): spans as arrays of (s, k, e, sb, eb), by start then kind; ``carry`` becomes column ``row``.

    A markov span that lies within one of the patterns is left out; one that
    reaches beyond it stays, so that ``redact`` covers the whole run.
    """
    extra, kept = ([], []) if carry is None else ([carry.alias("row")], ["row"])
    df = docs.select(col(id_col).alias("doc_id"), whole_text(text_col).alias("text"), *extra)
    df = df.withColumns(base_spans() | {"markov": _markov_spans(model)})
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]]
    df = df.select("doc_id", *kept, "text", *counts, F.array_sort(F.concat(*KINDS)).alias("found"))
    # the furthest end of a pattern's span that starts no later: a markov span that ends no further lies within it
    inside = running("transform(found, x -> IF(x.k < 3, x.e, 0L))", "greatest")
    df = df.withColumn("spans", F.expr(f"IF(size(found) = 0, found, {let(inside, 'r', 'filter(found, (x, i) -> x.k < 3 OR r[i] < x.e)')})"))
    return df.withColumn("base", F.expr("filter(spans, x -> x.k < 3)")).drop("found")


def _listed(name: str) -> Column:
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({name}, x -> concat({kinds}[x.k], ':', x.s, ':', x.e)), ',')")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one), all columns kept; ``n_chars`` follows."""
    found = scan(docs, train(docs, id_col, text_col, train_docs), id_col, text_col, carry=F.struct(*[col(c) for c in docs.columns]))
    # bytes are cut, as a place among them is found without reading those before; spans that overlap share one mark
    first = "filter(sequence(0, size(spans) - 1), i -> IF(i = 0, true, spans[i].sb >= r[greatest(i - 1, 0)]))"
    before = lambda i: f"IF({i} = 0, 0L, r[greatest({i} - 1, 0)])"
    cut = lambda start, length: f"CAST(substring(raw, CAST({start} + 1 AS INT){length}) AS STRING)"
    gaps = f"transform({first}, i -> {cut(before('i'), f', CAST(spans[i].sb - {before('i')} AS INT)')})"
    whole = f"array_join(array_append({gaps}, {cut('r[size(r) - 1]', '')}), '{mark}')"
    clean = F.expr(f"IF(size(spans) = 0, text, {let('CAST(text AS BINARY)', 'raw', let(running('transform(spans, x -> x.eb)', 'greatest'), 'r', whole))})")
    found = found.withColumn("clean", clean)
    hit = F.size("spans") > 0
    new = {text_col: F.when(hit, F.col("clean")).otherwise(F.col("row").getField(text_col))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length("clean")).otherwise(F.col("row").getField("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: secrets of every document."""
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
