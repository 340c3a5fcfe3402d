"""Rows that every document operator must take: nulls, empty and long texts, repeated rows, columns with clashing names."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, letters="abcdeéñ"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(n))


def odd_documents(spark, seed=1):
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randint(0, 60)), "en", rng.choice(["a", "b", "Z", None]), 0) for i in range(60)]
    rows += [(100, None, None, None, None), (101, "", "en", "a", 0), (102, " \n\t\x0b\f\r ", "en", "b", 7), (None, "null id here", "en", "a", 12),
             (None, None, None, None, None), (103, "One. Two, THREE!\nOne. Two, THREE!", "en", "b", 32), (103, "One. Two, THREE!\nOne. Two, THREE!", "en", "b", 32),
             (104, words(rng, 30_000), "en", "a", 0), (105, "x" * 50_000, "en", "c", 50_000), (106, "same words " * 400, "en", "c", 4400),
             (107, rows[5][1], "fr", "b", 0), (108, rows[5][1], "fr", "a", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df, names):
    """The same rows with further columns named as the operators name their own."""
    return df.withColumns({n: F.lit("clash") for n in names if n not in df.columns})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted(map(str, df.collect()))
