import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.common import join_counted


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_groups(fps, radius=2):
    """Least index reachable for each fingerprint."""
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def flips(fp, n):
    for b in random.sample(range(64), n):
        fp ^= 1 << b
    return fp


def test_near_counts_as_popcount_does():
    rng = np.random.default_rng(13)
    centre = int(rng.integers(0, 1 << 62))
    random.seed(13)
    values = np.array([flips(centre, random.randrange(7)) for _ in range(1500)] + rng.integers(0, 1 << 62, 500).tolist(), np.uint64)
    sliced, places = simhash.planes(values)
    for radius in (1, 2, 3, 5):
        for q in (centre, int(values[7]), int(values[-1])):
            got = np.unpackbits(simhash.near(sliced, places, q, radius).view(np.uint8), bitorder="little")[: len(values)].astype(bool)
            # places where all values agree are left out, so the query must agree there too
            if (q ^ int(values[0])) & ~sum(1 << p for p in places) == 0:
                assert (got == (np.bitwise_count(values ^ np.uint64(q)) <= radius)).all()


def test_tree_spans_components():
    random.seed(14)
    fps = list({flips(12345678901234567, random.randrange(9)) for _ in range(300)})
    values = np.array(fps, np.uint64)
    pairs = np.array(list(simhash.tree(values)), np.int64).reshape(-1, 2)
    assert len(pairs) < len(fps)
    up = dict(simhash.roots(pairs).tolist()) if len(pairs) else {}
    assert [up.get(i, i) for i in range(len(fps))] == brute_groups(fps)


def test_links_lose_no_pair_of_a_dense_group(spark):
    random.seed(15)
    fps = list({flips(0x0123456789ABCDEF, random.randrange(6)) for _ in range(400)} | {random.getrandbits(63) for _ in range(100)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "node long, fp long")
    found = {r.u: r.v for r in simhash.components(simhash.links(nodes)).collect()}
    assert [found.get(i, i) for i in range(len(fps))] == brute_groups(fps)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    found = {r.u: r.v for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {x: 100 for x in range(101, 140)}
    assert simhash.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_groups(docs):
    got = simhash.groups(docs).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            assert r.fingerprint == f"{brute_fingerprint(texts[r.doc_id]):016x}"
    ids = sorted(texts)
    want = brute_groups([brute_fingerprint(texts[i]) for i in ids])
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {i: ids[w] for i, w in zip(ids, want, strict=True)}
    # without an id, only an equal fingerprint with one names a group
    assert sorted(r.component_id for r in got if r.doc_id is None) == [0, 2]
    assert simhash.groups(docs.limit(0)).count() == 0


def test_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    components = {r.component_id for r in simhash.groups(docs).where("doc_id is not null").collect()}
    assert ids == sorted(components)
    assert kept.where(F.col("doc_id").isNull()).count() == 2


def test_rows_that_repeat_an_id_are_grouped_by_their_texts(spark):
    a, b = "one two three four five six", "quite another text that has nothing of the first"
    for rows, want in (
        ([(3, a), (5, a), (5, b), (9, b)], [(3, a), (5, b)]),
        ([(5, a), (5, b)], [(5, a), (5, b)]),
        ([(None, a), (None, a), (7, b), (None, b)], [(None, a), (7, b)]),
        ([(1, a), (1, a), (2, None), (2, "")], [(1, a), (2, "")]),
    ):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = [(r.doc_id, r.text or "") for r in simhash.keep_one(docs, keep_unnamed=False).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_every_group_of_random_rows_keeps_exactly_one(spark):
    random.seed(16)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(random.choices(words, k=30)) for _ in range(12)]
    rows = [(random.choice([None, *range(6)]), random.choice([*texts, None, ""])) for _ in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    roots = brute_groups([brute_fingerprint(t) for _, t in rows])
    groups = {}
    for (i, t), root in zip(rows, roots, strict=True):
        groups.setdefault(root, []).append((i is None, i or 0, t or ""))
    want = {root: min(g)[:2] for root, g in groups.items()}
    kept = [(r.doc_id is None, r.doc_id or 0, r.text or "") for r in simhash.keep_one(docs, keep_unnamed=False).collect()]
    root_of = {t or "": root for (_, t), root in zip(rows, roots, strict=True)}
    assert len(kept) == len(want)
    assert {root_of[t]: (a, b) for a, b, t in kept} == want
    named = {r.fingerprint: r.component_id for r in simhash.groups(docs).collect()}
    for (_, t), root in zip(rows, roots, strict=True):
        ids = [i for without, i, _ in groups[root] if not without]
        assert named[f"{brute_fingerprint(t):016x}"] == (min(ids) if ids else None)


def test_join_of_hot_keys(spark):
    rows = spark.createDataFrame([(k, i) for i in range(300) for k in ([1] * 3 + [i])], "k long, i long")
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), (F.max("k") * 10).alias("x"))
    want = sorted((r.k, r.i, r.k * 10) for r in rows.collect())
    for hot_rows in (1, 5, 10_000):
        assert sorted(map(tuple, join_counted(rows, facts, "k", "n", hot_rows=hot_rows).select("k", "i", "x").collect())) == want
