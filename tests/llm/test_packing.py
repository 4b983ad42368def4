import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing


def test_fullest_is_the_best_sum():
    random.seed(11)
    for _ in range(200):
        counts = {n: random.randrange(1, 4) for n in random.sample(range(1, 30), 5)}
        room = random.randrange(40)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= room}
        for choose in (packing.even, packing.steep):
            for slack in (0, 3):
                got = choose(counts, room, slack)
                assert max(sums) - slack <= sum(got) <= max(sums)
                assert all(k <= counts[n] for n, k in Counter(got).items())
            assert sum(choose(counts, room)) == max(sums)


def test_plan_uses_all_and_is_tight():
    random.seed(12)
    histogram = Counter(random.choices(range(1, 101), weights=[1 / (1 + abs(i - 30)) for i in range(100)], k=5000))
    planned = packing.plan(dict(histogram), 100)
    used = Counter()
    for combination, times in planned:
        assert sum(combination) <= 100
        for n in combination:
            used[n] += times
    assert used == histogram
    bins, least = sum(t for _, t in planned), -(-sum(n * c for n, c in histogram.items()) // 100)
    assert bins <= least * 1.01 + 1
    assert packing.plan({}, 100) == []


def best_fit_decreasing(histogram, capacity):
    room, bins = [0] * (capacity + 1), 0
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            r = next((r for r in range(n, capacity + 1) if room[r]), None)
            bins, r = (bins + 1, capacity) if r is None else (bins, r)
            if room[r]:
                room[r] -= 1
            room[r - n] += 1
    return bins


def test_ways_to_choose():
    assert packing.steep({5: 1, 4: 2, 3: 3}, 10) == [4, 3, 3]
    assert packing.steep({5: 1, 4: 2, 3: 3}, 10, 1) == [5, 4]
    assert packing.even({9: 1, 5: 2, 4: 2, 1: 5}, 10) == [5, 5] and packing.steep({9: 1, 5: 2, 4: 2, 1: 5}, 10) == [9, 1]
    assert packing.even({}, 10, 3) == packing.steep({}, 10, 3) == []


def test_never_more_sequences_than_best_fit_decreasing():
    rng = random.Random(13)
    for _ in range(120):
        capacity = rng.choice([50, 100, 300, 1024])
        low = rng.randint(1, capacity // 3)
        lengths = [rng.randint(low, rng.randint(low + 1, capacity)) for _ in range(rng.choice([20, 100, 400]))]
        planned = packing.plan(dict(Counter(lengths)), capacity)
        assert packing.lengths_of(planned) == Counter(lengths)
        assert all(sum(c) <= capacity for c, _ in planned)
        assert packing.sequences(planned) <= best_fit_decreasing(Counter(lengths), capacity)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_given_tables_take_no_more_than_best_fit_decreasing(spark, vocabulary, sf):
    """Places on a given table neither overlap nor leave a gap, and are as few as they can be."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = packing.pack(docs, vocabulary("byte_bpe_50k.json"), 1024, end_id=2).select("doc_id", "length", "sequence_id", "offset").toPandas()
    got = got.sort_values(["sequence_id", "offset"])
    ends = got.groupby("sequence_id").length.cumsum()
    assert (got.offset == ends - got.length).all() and ends.max() <= 1024
    assert got.doc_id.nunique() == docs.count()
    used, histogram = got.sequence_id.nunique(), Counter(got.length.tolist())
    assert used <= best_fit_decreasing(histogram, 1024)
    assert used == -(-got.length.sum() // 1024)


def test_pack(docs, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    capacity = 64
    got = packing.pack(docs, path, capacity, end_id=2).toPandas()
    library = Tokenizer.from_file(path)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = Counter(r.doc_id for r in docs.collect())
    for i, own in got.groupby("doc_id"):
        ids = np.array([*library.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        assert own.length.sum() == len(ids) * rows[i]
        for r in own.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
            assert r.length == capacity or r.piece == 0
    order = got.sort_values(["sequence_id", "offset"])
    ends = (order.offset + order.length).groupby(order.sequence_id).shift(1).fillna(0)
    assert (ends == order.offset).all()
    assert (order.offset + order.length).max() <= capacity
    assert got.sequence_id.nunique() <= -(-got.length.sum() // capacity) + 1
    assert packing.pack(docs.limit(0), path, capacity, end_id=2).count() == 0


def test_long_runs_of_white_space(spark, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    n = 1_001_000
    texts = ["a" + "\n" * n + "b", "One <|endoftext|> é" + " " * n, " \n" * (n // 2) + "\u3000x 12<|endoftext|>", "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.pack(docs, path, 1 << 21, end_id=2).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array([*library.encode(texts[r.doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
