"""Operator 7 against plain Python."""

import re
import time
from itertools import accumulate

from tests.llm.helpers import SCHEMA, clashing, empty, odd_documents

from farelane.llm import line_quality as Q
from farelane.llm.common import running

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(text):
    t = text or ""
    w = WORD.findall(t)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, x in enumerate(win) if win.count(x) > 1 for k in range(5)} if len(win) < 5000 else None
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, None if covered is None else len(covered)


def test_base_counts_equal_brute_force(spark):
    df = odd_documents(spark).where("doc_id IS NULL OR doc_id <> 104")
    more = spark.createDataFrame([(200, "a b c d e f a b c d e x y", "en", "a", 0), (201, "a a a a a a a", "en", "a", 0), (202, "l\nl\n\n \nl \nl", "en", "a", 0)], SCHEMA)
    df = df.unionByName(more)
    texts = sorted((str(r.doc_id), r.text or "") for r in df.collect())
    want = sorted((i, *_brute(t)) for i, t in texts)
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.quality(clashing(df, ["words", "lines", "kept", "failed"])).collect())
    assert got == want
    for r in Q.quality(df).collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.kept and r.base_failed)


def test_lines_fail_first_then_documents(spark):
    clean = "This is a plain line of prose that says something.\nAnd this is another one of them, no worse."
    menu = "Home\nHome | About | News | Contact\nAll rights reserved.\n"
    noise = "BUY!! NOW!! CHEAP!! STUFF!! HERE!! TODAY!! ONLY!! FOR!! YOU!! AND!! ME!!"
    df = spark.createDataFrame([(1, clean, "en", "a", 99), (2, menu + clean, "en", "a", 0), (3, noise, "en", "a", 0), (4, noise + "\n" + clean, "en", "a", 0), (5, None, "en", "a", 0)], SCHEMA)
    rows = {r.doc_id: r for r in Q.quality(df).collect()}
    assert {i: r.kept for i, r in rows.items()} == {1: True, 2: True, 3: False, 4: True, 5: False}
    assert rows[1].clean_text == clean and rows[2].clean_text == clean and rows[2].n_failed_lines == 3 and noise not in rows[4].clean_text
    kept = {r.doc_id: r for r in Q.keep_good(clashing(df, ["row", "kept", "stays", "words"])).collect()}
    assert set(kept) == {1, 2, 4} and kept[1].n_chars == 99 and kept[2].text == clean and kept[2].n_chars == len(clean)
    assert Q.keep_good(empty(spark)).count() == 0 and Q.quality(empty(spark)).count() == 0


def test_very_long_text(spark):
    df = odd_documents(spark).where("doc_id = 104").selectExpr("doc_id", "concat(text, ' ', text) AS text")
    r = Q.quality(df).first()
    assert r.n_words == 60_000 and r.n_repeat_words == 60_000


def test_no_python_in_the_plan(spark):
    plan = Q.keep_good(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_many_failing_lines_in_one_text_cost_in_proportion(spark):
    took = {}
    for n in (1000, 16_000, 64_000):
        text = "\n".join(f"fine line {i} is here and stays\n|» · | » | · | {i} |\nHome" for i in range(n))
        df = spark.createDataFrame([(1, text, "en", "a", 0)], SCHEMA)
        start = time.time()
        r = Q.quality(df, max_lost=1.0).first()
        took[n] = time.time() - start
        assert (r.n_lines, r.n_failed_lines) == (3 * n, 2 * n) and r.clean_text == "\n".join(f"fine line {i} is here and stays" for i in range(n))
    assert took[64_000] < 10 * max(took[16_000], 0.5)


def test_running_results(spark):
    import random

    rng = random.Random(1)
    rows = [[], [5]] + [[rng.randint(-9, 9) for _ in range(n)] for n in (2, 3, 4, 9, 10, 99, 1000, 5000)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a array<bigint>")
    for r in df.selectExpr("i", f"{running('a', '+')} AS s", f"{running('a', 'greatest')} AS g").collect():
        assert r.s == list(accumulate(rows[r.i])) and r.g == list(accumulate(rows[r.i], max))
