import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def cut(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, cut(t)) for i, t in docs]
    held = [(i, ws) for i, ws in held if ws]
    n, total = len(held), sum(len(ws) for _, ws in held)
    df = Counter(t for _, ws in held for t in set(ws))
    texts = {}
    for i, t in items:
        texts[i] = t if texts.get(i) is None else texts[i] if t is None else min(texts[i], t)
    out = []
    for item, text in texts.items():
        found = []
        for i, ws in held:
            tf = Counter(ws)
            m = 100 - 90 + (90 * len(ws) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in set(cut(text)) if t in tf)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def texts(n, seed, words=400):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeféß漢") for _ in range(rng.randint(1, 6))) for _ in range(words)]
    return [rng.choice([" ", ", ", "_", "\n"]).join(rng.choices(vocabulary, k=rng.choice([1, 3, 20, 60, 300]), weights=[1 / (i + 1) for i in range(words)])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_results_are_those_of_brute_force(spark, seed):
    docs = [*enumerate(texts(700, seed)), (None, None), (3, "Twice"), (None, "twice twice"), (900, ""), (901, "  \t .,;")]
    docs += [(1000 + i, docs[5][1]) for i in range(30)]  # equal scores
    items = [*enumerate(texts(25, seed + 10)), (None, docs[5][1]), (4, "aa"), (77, None), (78, "!!"), (79, "TWICE zzzzzz"), (80, docs[5][1].upper())]
    frame = spark.createDataFrame(docs, DOCS).repartition(6)
    got = sorted(map(tuple, lexical.search(frame, spark.createDataFrame(items, ITEMS)).collect()), key=str)
    assert got == brute(docs, items)


def test_in_rounds_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ROUND_ITEMS", 4)
    monkeypatch.setattr(lexical, "BLOCK", 16)
    monkeypatch.setattr(lexical, "LOOKUP", 3)
    monkeypatch.setattr(lexical, "HELD_TERMS", 20)
    docs, items = [*enumerate(texts(200, 7))], [*enumerate(texts(15, 8))]
    got = sorted(map(tuple, lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k=3).collect()), key=str)
    assert got == brute(docs, items, 3)


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(3)
    n = 40
    row = np.repeat(np.arange(n), 500)
    code = rng.integers(0, 1 << 32, len(row))
    impact = rng.integers(1, 1_000_000, len(row))
    sketch = lexical.Sketches(n, row, code, impact)
    for d in range(n):
        own = np.flatnonzero(row == d)[:50]
        weight = rng.integers(0, 20_000, len(own)).astype(float)
        bound = sketch.bounds(lexical.cells_of(code[own]), weight)[d]
        assert bound >= (weight * impact[own]).sum()


def test_few_documents_are_scored_exactly():
    """Most documents are ruled out by their bounds."""
    docs = texts(2000, 11)
    counts = Counter(t for d in docs for t in set(cut(d)))
    corpus = lexical.Corpus(len(docs), sum(len(cut(d)) for d in docs))
    asked = [t for t, c in counts.items() if 3 <= c <= 60][:8]
    items = lexical.Items([([t.encode() for t in asked], [1000] * len(asked))], 10)
    for a in range(0, len(docs), lexical.BLOCK):
        items.add(list(range(a, min(a + lexical.BLOCK, len(docs)))), [d.encode() for d in docs[a : a + lexical.BLOCK]], corpus)
    assert items.compared < len(docs) / 8
    m = {i: 8 * corpus.damping(len(cut(d))) for i, d in enumerate(docs)}
    want = sorted((-sum(1000 * (10**9 * tf // (1000 * tf + m[i])) for t, tf in Counter(cut(d)).items() if t in asked), i) for i, d in enumerate(docs))[:10]
    assert [(s, i) for s, _, i in items.best[0]] == want


def test_empty_tables_and_odd_rows(spark, docs):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "word emoji")], ITEMS)
    assert lexical.search(none, some).count() == 0
    assert lexical.search(docs, spark.createDataFrame([], ITEMS)).count() == 0
    assert lexical.search(spark.createDataFrame([(1, None), (2, "")], DOCS), some).count() == 0
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, lexical.search(docs, some).collect()), key=str) == brute(rows, [(1, "word emoji")])
    bad = spark.sql("SELECT 1L AS doc_id, cast(x'616263ff20646566' AS string) AS text UNION ALL SELECT 2L, 'xyz' UNION ALL SELECT 3L, 'def'")
    found = lexical.search(bad, spark.createDataFrame([(1, "def")], ITEMS)).collect()
    assert [r.doc_id for r in found] == [3, 1] or [r.doc_id for r in found] == [1, 3]


def test_a_text_of_megabytes_is_whole(spark):
    docs = [(1, "alpha " * 400_000 + "omega"), (2, "alpha"), (3, "beta")]
    got = sorted(map(tuple, lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, "omega alpha")], ITEMS)).collect()), key=str)
    assert got == brute(docs, [(1, "omega alpha")])
