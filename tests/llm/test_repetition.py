import random
import re
from collections import Counter

from millrace.llm import repetition


def brute(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)

    def inside(n):
        c = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        return {k for i in range(len(w) - n + 1) if c[tuple(w[i : i + n])] > 1 for k in range(i, i + n)}

    seen, dup, chars = set(), 0, 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            if line in seen:
                dup, chars = dup + 1, chars + len(line)
            seen.add(line)
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)), "n_dup_lines": dup,
        "dup_line_chars": chars, "n_repeat_words": len(inside(3)), **{f"dup_{n}": sum(len(w[i]) for i in inside(n)) for n in range(5, 11)},
    }


def test_counts_are_those_of_brute_force(pack_texts):
    random.seed(9)
    pieces = ["a", "b", "é", "c#", "|", " ", "\n", "\t", "\x0b", " a b a\n", "\x85", "\xa0", "漢 "]
    texts = ["".join(random.choices(pieces, k=random.choice([0, 1, 5, 40, 200]))) for _ in range(400)]
    found = repetition.measure(*pack_texts(texts))
    for i, t in enumerate(texts):
        for name, value in brute(t).items():
            assert found[name][i] == value, (t, name)


def test_verdicts(pack_texts):
    random.seed(10)
    words = [f"w{i}" for i in range(5000)]
    clean = " ".join(random.sample(words, 300))
    lines = "\n".join([" ".join(random.sample(words, 8))] * 30)
    passage = " ".join(words[:60])
    texts = [clean, clean[:50], lines, f"{passage} {clean} {passage}", "a b " * 100]
    found = repetition.measure(*pack_texts(texts))
    base_failed, kept = repetition.verdict(found)
    assert kept.tolist() == [True, False, False, False, False]
    assert base_failed.tolist() == [False, True, True, False, True]


def test_judge(docs):
    got = repetition.judge(docs).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            assert all(r[k] == v for k, v in brute(texts[r.doc_id]).items())
    assert repetition.judge(docs.limit(0)).count() == 0
