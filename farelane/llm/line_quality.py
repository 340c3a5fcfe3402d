"""Line-first quality rules, DataFrame functions only (operator 7).

Every line of a text is judged on its own; failing lines are removed, and a
document that loses too much of its text, or fails the whole-text base rules,
is rejected. Texts stay in their rows: no shuffle, no Python.

Line rules (a line without a word is neither judged nor removed):

* punctuation: at least ``symbol_share`` of its words hold a run of two or
  more symbols such as ``!!`` or ``$$$``;
* navigation: three or more separators (``|``, ``»``, ``·``, ``>``) stand
  alone between words, or the line is only a menu word;
* boilerplate: it holds a stock phrase (licences, cookies, scripts).

A document is rejected if the removed lines hold more than ``max_lost`` of its
word characters.

Defined results: null and empty texts have no words and fail the base rules;
repeated rows are judged alike; an empty table gives no rows; texts have no
length limit, and repeated windows cost n log n. Extra columns are ignored by
``quality`` and kept by ``keep_good``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.common import SPACE_CLASS, WORD_PATTERN, col, once, table, whole_text

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOL_SHARE = 0.3
MAX_LOST = 0.5

SYMBOL_RUN = r"[!?#*$%&|<>~^=+]{2,}"
SEPARATOR = r"[\x20\x09][|»·>][\x20\x09]"
MENU_LINE = (r"(?i)^[\x20\x09-\x0D]*(home|menu|main menu|next|next page|previous|previous page|login|log in|sign in|sign up|"
             r"back to top|skip to content|read more|share|search|contact us|about us|sitemap)[\x20\x09-\x0D.:>]*$")
BOILERPLATE = (r"(?i)all rights reserved|licensed under|(accept|use|uses) cookies|cookie policy|privacy policy|terms of (use|service)|"
               r"enable javascript|subscribe to our|click here to|copyright (\(c\)|©|20)")


def _repeated_words(window: int) -> tuple[str, str]:
    """Two steps over array column ``words``: hashes of its windows, then the words that lie in repeated windows.

    Windows are compared by a 64-bit hash chained over their words. Texts
    without a repeat, nearly all, stop after one hash set; others sort
    (hash, position) pairs and add up the words that repeated windows cover.
    """
    args = ", ".join(f"words[i + {k}]" for k in range(window))
    hashes = f"IF(size(words) < {window}, CAST(array() AS ARRAY<BIGINT>), transform(sequence(0, size(words) - {window}), i -> xxhash64({args})))"
    pairs = "array_sort(transform(hashes, (x, i) -> struct(x AS x, i AS i)))"
    again = "filter(s, (e, k) -> (k > 0 AND s[greatest(k - 1, 0)].x = e.x) OR (k < size(s) - 1 AND s[least(k + 1, size(s) - 1)].x = e.x))"
    covered = (f"aggregate(array_sort(transform({again}, e -> e.i)), struct(-{window} AS last, 0L AS n), "
               f"(a, i) -> struct(i AS last, a.n + CAST(least({window}, i - a.last) AS BIGINT) AS n), a -> a.n)")
    # transform over an array of one element names the sorted pairs: they are not sorted again inside a lambda
    return hashes, f"IF(size(array_distinct(hashes)) = size(hashes), 0L, transform(array({pairs}), s -> {covered})[0])"


def _line_fails(symbol_share: float) -> str:
    """SQL over lambda variable ``l``, a line that holds a word."""
    words = f"size(filter(split(l, r'{SPACE_CLASS}+'), w -> w <> ''))"
    return (f"regexp_count(l, r'{SYMBOL_RUN}') >= {symbol_share} * {words} OR regexp_count(l, r'{SEPARATOR}') >= 3 "
            f"OR l RLIKE r'{MENU_LINE}' OR l RLIKE r'{BOILERPLATE}'")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
            max_repeat_percent: int = MAX_REPEAT_PERCENT, window: int = WINDOW, symbol_share: float = SYMBOL_SHARE,
            max_lost: float = MAX_LOST, carry: Column | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_failed_lines, lost_chars, clean_text (without failed lines), kept; ``carry`` becomes column ``row``.
    """
    spaces = lambda c: F.array_remove(F.split(c, SPACE_CLASS + "+"), "")
    hashes, repeated = _repeated_words(window)
    extra = [] if carry is None else [carry.alias("row")]
    kept_row = [] if carry is None else ["row"]
    letters = f"length(regexp_replace(l, r'{SPACE_CLASS}+', ''))"
    df = docs.select(col(id_col).alias("doc_id"), whole_text(text_col).alias("text"), *extra)
    df = df.withColumns({"words": spaces(F.col("text")), "lines": F.split("text", "\n")})
    df = df.withColumns({
        "hashes": F.expr(hashes), "n_words": F.size("words").cast("bigint"),
        "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
        "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint"),
        # each line is judged once: does it hold a word, and does it then fail
        "judged": F.expr(f"transform(lines, l -> IF(l RLIKE r'{WORD_PATTERN}', struct(l AS l, true AS word, ({_line_fails(symbol_share)}) AS bad), "
                         "struct(l AS l, false AS word, false AS bad)))")})
    df = df.withColumn("full_lines", F.expr("transform(filter(judged, x -> x.word), x -> x.l)"))
    df = df.withColumns({
        "n_repeat_words": F.expr(repeated),
        "n_dup_lines": (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("bigint"),
        "failed": F.expr("transform(filter(judged, x -> x.bad), x -> x.l)")})
    df = df.withColumns({
        "base_failed": (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")),
        "lost_chars": F.expr(f"aggregate(failed, 0L, (a, l) -> a + {letters})"),
        "clean_text": F.expr("IF(size(failed) = 0, text, array_join(transform(filter(judged, x -> NOT x.bad), x -> x.l), '\n'))")})
    return df.select("doc_id", *kept_row, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     F.size("full_lines").cast("bigint").alias("n_lines"), F.size("failed").cast("bigint").alias("n_failed_lines"),
                     "lost_chars", "clean_text",
                     (~F.col("base_failed") & (F.col("lost_chars") <= max_lost * F.col("word_chars"))).alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """The documents that ``quality`` keeps, cleaned of failed lines, with the columns of ``docs`` (``n_chars`` follows the text)."""
    judged = quality(docs, id_col, text_col, carry=F.struct(*[col(c) for c in docs.columns]), **rules).withColumn("stays", once(F.col("kept"))).where("stays")
    new = {text_col: F.col("clean_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_failed_lines") > 0, F.length("clean_text")).otherwise(
            F.col("row").getField("n_chars")).cast(docs.schema["n_chars"].dataType)
    return judged.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: base counts and verdict of every document."""
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}') AS words FROM documents),
w AS (SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS win
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {WINDOW - 2}, 1))) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1),
c AS (SELECT doc_id, sum(least({WINDOW}, i - coalesce(prev, i - {WINDOW}))) AS n_repeat_words
      FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
j AS (SELECT doc_id, line, length(regexp_replace(line, '{SPACE_CLASS}+', '', 'g')) AS letters,
             len(regexp_extract_all(line, '{SYMBOL_RUN}')) >= {SYMBOL_SHARE} * len(regexp_extract_all(line, '{WORD_PATTERN}'))
             OR len(regexp_extract_all(line, '{SEPARATOR}')) >= 3
             OR regexp_matches(line, '{MENU_LINE}') OR regexp_matches(line, '{BOILERPLATE}') AS failed
      FROM l WHERE regexp_matches(line, '{WORD_PATTERN}')),
g AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(CASE WHEN failed THEN letters ELSE 0 END) AS lost FROM j GROUP BY doc_id),
b AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(g.n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(g.lost, 0) AS lost
  FROM d LEFT JOIN g USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND lost <= {MAX_LOST} * word_chars AS kept
FROM b
"""
