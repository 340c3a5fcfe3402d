"""The pipeline, stage by stage on the stage's own input, against plain Python on a small corpus."""

import hashlib
import re
from collections import Counter

import corpus_pipeline as P
from tests.llm.helpers import SCHEMA, clashing, empty, odd_documents
from tests.llm.test_secret_scan import _base, _markov, _plain_redact
from tests.llm.test_simhash_golay import _brute as brute_components
from tests.llm.test_source_mix import _targets

from farelane.llm import line_quality as Q
from farelane.llm import secret_scan, word_tokens
from farelane.session import materialize


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain_quality(text):
    """The text without its failed lines, or None where the document is rejected."""
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    if len(w) < 10 or 100 * len(covered) > 20 * len(w):
        return None
    kept, lost = [], 0
    for line in text.split("\n"):
        words = WORD.findall(line)
        if words and (len(re.findall(Q.SYMBOL_RUN, line)) >= Q.SYMBOL_SHARE * len(words) or len(re.findall(Q.SEPARATOR, line)) >= 3
                      or re.search(Q.MENU_LINE, line) or re.search(Q.BOILERPLATE, line)):
            lost += sum(map(len, words))
        else:
            kept.append(line)
    return "\n".join(kept) if lost <= Q.MAX_LOST * sum(map(len, w)) else None


def _plain_clean(text, model):
    base = [(int(s), k, int(e)) for k, s, e in (x.split(":") for x in _base(text).split(",") if x)]
    return _plain_redact(text, [(s, k, e) for s, k, e in base] + [(s, "markov", e) for s, _, e in _markov(text, model)])


def _plain_mix(rows):
    size = {i: len(WORD.findall(t)) for i, _, t in rows}
    source = Counter()
    for i, s, _ in rows:
        source[s] += size[i]
    targets, out = _targets(source), []
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    for s in source:
        epochs, rest = divmod(int(targets[s] + 0.5), source[s])
        for i, _, t in sorted((r for r in rows if r[1] == s), key=lambda r: md5(f"mix-1:{r[0]}:{md5(r[2])}")):
            part = max(0, min(size[i], rest))
            rest -= part
            out += [(i, t)] * (epochs + (part == size[i]))
            if 0 < part < size[i]:
                out.append((i, "".join(re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", t)[:part])))
    return out


def _stages(spark, docs, sf):
    out = [docs]
    for _, f in P.STAGES:
        out.append(materialize(f(spark, out[-1], sf)))
    return out


def test_stages_do_what_they_say(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    secret = "one two three four five six seven eight nine ten password = abcdef123 and eleven 0123456789abcdef0123456789abcdef more"
    docs = docs.unionByName(spark.createDataFrame([(9000 + i, f"{w} {secret} {w}", "en", "src1", 0) for i, w in enumerate(["alpha beta", "gamma"])], SCHEMA))
    given, good, single, clean, mixed, packed = _stages(spark, docs, sf)
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_dedup", "secret_redaction", "source_mixing", "window_packs"]
    for d in (good, single, clean, mixed):
        assert d.columns == docs.columns
    # 1: exactly the documents that plain Python keeps, without the lines that it fails
    verdict = {r.doc_id: _plain_quality(r.text) for r in given.collect()}
    assert {r.doc_id: r.text for r in good.collect()} == {i: t for i, t in verdict.items() if t is not None}
    assert any(t is None for t in verdict.values())
    # 2: the smallest id of each component of the stage's own input
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in brute_components(rows)}
    # 3: every span that plain Python finds under the stage's models is replaced, and nothing else
    model = secret_scan.train(single)
    want = {r.doc_id: _plain_clean(r.text, model) for r in single.collect()}
    assert {r.doc_id: r.text for r in clean.collect()} == want and any(want[r.doc_id] != r.text for r in single.collect())
    # 4: whole epochs and an exact cut in the order of plain MD5 keys
    assert sorted((r.doc_id, r.text) for r in mixed.collect()) == sorted(_plain_mix([(r.doc_id, r.source, r.text) for r in clean.collect()]))
    # 5: every token of every copy lies in one piece
    t = word_tokens._tokenizer(word_tokens.tokenizer_path())[0]
    tokens = Counter()
    for r in mixed.collect():
        tokens[r.doc_id] += len(t.encode(r.text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in packed.collect():
        got[r.doc_id] += r.length
    assert got == tokens


def test_run_and_odd_inputs(spark, sf):
    assert P.run(spark, sf).count() > 0
    docs = clashing(odd_documents(spark), ["row", "words", "kept", "spans", "size"])
    assert _stages(spark, docs, sf)[-1].count() > 0
    assert _stages(spark, empty(spark), sf)[-1].count() == 0
    one = spark.createDataFrame([(None, "a plain text of more than ten words is kept by the rules here", None, None, None)], SCHEMA)
    assert [d.count() for d in _stages(spark, one, sf)] == [1] * 6
