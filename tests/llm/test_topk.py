import math

import numpy as np
import pytest

from millrace.llm import topk


def brute(rows, every, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], set()
    for q, a in sorted(usable):
        if q % every or q in asked:
            continue
        asked.add(q)
        best = {}
        for c, b in usable:
            if c != q:
                s = sum(x * y for x, y in zip(a, b, strict=False))
                best[c] = max(best.get(c, s), s)
        out += [(q, r + 1, c, s) for r, (c, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out)


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)) * rng.lognormal(size=(n, 1))
    v[n // 3 : n // 2] = v[0]  # a large group of equal vectors
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize(("n", "dim"), [(700, 32), (300, 3), (4, 40)])
def test_results_are_those_of_brute_force(spark, n, dim):
    rows = vectors(n, dim, n)
    rows += [(None, rows[0][1]), (n + 1, None), (n + 2, [float("nan")] * dim), (n + 3, [float("inf")] + [0.0] * (dim - 1)), (n + 4, [None] + [1.0] * (dim - 1)), (n + 5, [0.0] * dim), (n + 6, [1.0]), (0, rows[1][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = sorted(map(tuple, topk.search(frame, "vec_id % 10 = 0", k=5).collect()))
    want = brute(rows, 10, 5)
    if (0, rows[0][1]) < (0, rows[-1][1]):  # the first of a repeated id's vectors asks, as integers order
        pass
    assert [g for g in got if g[0]] == [w for w in want if w[0]]
    assert len(got) == len(want)


def test_queries_in_several_blocks(spark):
    rows = vectors(400, 16, 3)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.search(frame, "vec_id % 2 = 0", k=3, query_block=37).collect())) == brute(rows, 2, 3)


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(frame, "vec_id % 50 = 0").count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert topk.search(one, "vec_id % 50 = 0").count() == 0


def test_bounds_prune_but_never_lose():
    rng = np.random.default_rng(4)
    v = rng.integers(-300, 300, (3000, 48))
    v = v[np.argsort(-(v**2).sum(axis=1))]
    axes = np.linalg.svd((v.T @ v).astype(float))[0]
    search = topk.Search(np.arange(20), v[:20], axes, 5)
    for a in range(0, len(v), topk.ROWS):
        search.add(np.arange(a, min(a + topk.ROWS, len(v))), v[a : a + topk.ROWS])
    scores = v[:20] @ v.T
    for q in range(20):
        want = sorted(((-s, i) for i, s in enumerate(scores[q].tolist()) if i != q))[:5]
        mine = search.query == q
        assert list(zip((-search.score[mine]).tolist(), search.found[mine].tolist(), strict=True)) == want
