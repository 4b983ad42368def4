import math
import re
import tempfile
from collections import Counter

import numpy as np
import pytest

from millrace.llm import ngram_lm, queries
from millrace.llm.elias_fano import EliasFano, from_file, pack, to_bytes, unpack


@pytest.mark.parametrize("n", [0, 1, 2, 64, 1000, 20000])
def test_elias_fano(n):
    rng = np.random.default_rng(n)
    for top in (1, 5, 1000, 1 << 40, (1 << 63) - 1):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        with tempfile.NamedTemporaryFile() as f:
            f.write(b"".join(to_bytes(EliasFano.build(values, "x"))))
            f.flush()
            sequence = EliasFano(from_file(f.name), "x")
        at = rng.integers(0, n, 100) if n else np.zeros(0, np.int64)
        assert (sequence.get(at) == values[at]).all()
        asked = np.concatenate([values[at], rng.integers(0, top, 100, dtype=np.uint64, endpoint=True)])
        rank = np.searchsorted(values, asked)
        hit = rank < n
        hit[hit] = values[rank[hit]] == asked[hit]
        assert (sequence.find(asked) == np.where(hit, rank, -1)).all()


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    for width in (1, 7, 8, 23, 56):
        values = rng.integers(0, 1 << width, 1000, dtype=np.uint64)
        assert (unpack(pack(values, width), width, np.arange(1000)) == values).all()
    a, b = ngram_lm.unsqueeze(ngram_lm.squeeze(np.arange(5, dtype=np.int64), np.arange(3, dtype=np.uint32)))
    assert a.tolist() == [0, 1, 2, 3, 4] and b.tolist() == [0, 1, 2]


def tokens(text):
    return ["<s>", *re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "</s>"]


def brute(train, texts, order, d=ngram_lm.DISCOUNT):
    counts = [Counter() for _ in range(order + 1)]
    for t in train:
        s = tokens(t)
        for i in range(1, len(s)):
            for n in range(1, min(order, i + 1) + 1):
                counts[n][tuple(s[i - n + 1 : i + 1])] += 1
    total, kinds = sum(counts[1].values()), len(counts[1])

    def base(w):
        return (counts[1][(w,)] + 0.1) / (total + 0.1 * (kinds + 1))

    def p(w, before):
        out = base(w)
        for n in range(2, order + 1):
            h = before[-(n - 1) :]
            seen = 0 if len(h) < n - 1 else len(train) if h == ("<s>",) else counts[n - 1][h]
            if seen:
                out = max(counts[n][(*h, w)] - d, 0) / seen + d * len({k for k in counts[n] if k[:-1] == h}) / seen * out
        return out

    rows = []
    for t in texts:
        s = tokens(t)
        rows.append((len(s) - 1, sum(counts[1][(w,)] > 0 for w in s[1:]), sum(math.log10(base(w)) for w in s[1:]), sum(math.log10(p(s[i], tuple(s[:i]))) for i in range(1, len(s)))))
    return total, rows


@pytest.mark.parametrize(("order", "file_tokens", "spread"), [(1, 20, 3), (2, 2_000_000, 200_000), (2, 20, 3), (3, 20, 3)])
def test_scores_are_those_of_brute_force(spark, order, file_tokens, spread):
    texts = ["a b c a b", "A b", "", None, "x y a b c d", "a b c", "b b b b a", "q", "c a b c a b d"] * 3 + ["a  b\tzz", "É é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = ngram_lm.fit(docs.where("doc_id % 4 <> 0"), order=order, file_tokens=file_tokens, spread_from=spread)
    total, want = brute([t for i, t in enumerate(texts) if i % 4], texts, order)
    assert model.tokens == total
    for r in ngram_lm.score(docs, model).collect():
        n, known, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known) == (n, known)
        assert abs(r.base_score - base) < 1e-9
        assert abs(r.score - score) < 3e-4 * n


def test_the_query_uses_contexts_of_two_words(spark, tmp_path):
    texts = ["a b c", "x b d", "a b c", "x b d", "a b d", "q"] * 40
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op2_ngram_lm(spark, str(tmp_path)).collect()
    _, want = brute([texts[r.doc_id] for r in rows if not r.held_out], [texts[r.doc_id] for r in rows], 3)
    for r, (n, _, _, score) in zip(rows, want, strict=True):
        assert abs(r.score - score) < 3e-4 * n


def test_probabilities_add_up(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c", "a c", "b a a", "c"])], "doc_id long, text string")
    model = ngram_lm.fit(docs)
    words = ["a", "b", "c"]
    step = lambda text: model.score(ngram_lm.Tokens(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])))[3][0]
    # P(next | a) over all words, the end and an unknown word, from scores of texts that differ in one token
    ended = {w: step(f"a {w}") for w in [*words, "unseen"]}
    assert all(np.isfinite(v) for v in ended.values())
    assert ended["unseen"] < min(ended[w] for w in words)


def test_edge_cases(docs):
    model = ngram_lm.fit(docs.limit(0))
    rows = ngram_lm.score(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(r.n_known == 0 and abs(r.base_score) < 1e-9 for r in rows)
    assert ngram_lm.score(docs.limit(0), ngram_lm.fit(docs)).count() == 0
