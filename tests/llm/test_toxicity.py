import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import common, toxicity

FIELDS = "doc_id long, text string"


def brute_features(text, feature_of=None):
    out = set()
    points = np.array([ord(c) for c in text.lower()], np.uint32)
    for n in toxicity.SIZES:
        for i in range(len(points) - n + 1):
            bucket = int(toxicity.hashed(points[i : i + n], n)[0])
            if feature_of is None:
                out.add(bucket)
            elif feature_of[bucket] >= 0:
                out.add(int(feature_of[bucket]))
    return out


def corpus(n=240):
    """Every fourth text insults; the others share all of its other words."""
    rng, words = np.random.default_rng(5), ["grass", "table", "winter", "Straße", "ocean", "paper", "漢字", "light"]
    rows, labels = [], []
    for i in range(n):
        found = rng.choice(words, 30).tolist()
        if i % 4 == 0:
            found[7], found[20] = "Blockhead", "nitwit"
        rows.append((i, " ".join(found)))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


@pytest.mark.parametrize("size", [1 << 20, 7, 16])
def test_features_are_those_of_each_text_alone(size):
    texts = ["abcabc", "", "ab", "a" * 50, "Straße 漢字 😀 x", "\x00\x00\x00\x00", "BLOCKHEAD and nitwit"]
    row, bucket = toxicity.held(texts, size=size)
    for i, t in enumerate(texts):
        assert set(bucket[row == i].tolist()) == brute_features(t)
    assert len(row) == sum(len(brute_features(t)) for t in texts)


def test_parts_cover_all_texts(monkeypatch):
    monkeypatch.setattr(toxicity, "PASS", 3)
    found = [*toxicity.parts(pa.array(["ab", "", "abcdef", "x", None, "yz"]))]
    assert found == [(0, 2, ["ab", ""]), (2, 3, ["abcdef"]), (3, 6, ["x", "", "yz"])]
    assert [*toxicity.parts(pa.array([], pa.string()))] == []


def test_counts_and_ratios_equal_brute_force(spark):
    rows, labels = corpus(60)
    sample = spark.createDataFrame([(float(y), t) for (_, t), (_, y) in zip(rows, labels, strict=True)], "_label double, _text string").repartition(3)
    counts = {r.bucket: (r.ones, r.zeros) for r in toxicity.counted(sample).collect()}
    want = {}
    for (_, t), (_, y) in zip(rows, labels, strict=True):
        for b in brute_features(t):
            ones, zeros = want.get(b, (0, 0))
            want[b] = (ones + y, zeros + 1 - y)
    assert counts == want
    buckets, ratio = toxicity.ratios(sample, 15, 45)
    for b, r in zip(buckets.tolist(), ratio.tolist(), strict=True):
        ones, zeros = want[b]
        assert r == pytest.approx(np.log((ones + 1) / 17) - np.log((zeros + 1) / 47))
    sure = [b for b, (p, q) in want.items() if p + q >= toxicity.MIN_TEXTS and abs(np.log((p + 1) / 17) - np.log((q + 1) / 47)) / np.sqrt(1 / (p + 1) + 1 / (q + 1)) >= toxicity.CERTAINTY]
    assert sorted(buckets.tolist()) == sorted(sure)


def test_held_out_texts_are_told_apart(spark):
    rows, labels = corpus()
    docs, marks = spark.createDataFrame(rows, FIELDS), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marks.where("doc_id < 160"), "toxic")
    got = {r.doc_id: r for r in toxicity.predict(docs, model).collect()}
    assert all((got[i].predicted == 1) == (i % 4 == 0) for i in range(240))
    table = model.table()
    for i in (0, 1, 163, 200):  # scores by hand
        total = model.intercept + sum(model.weights[f] for f in brute_features(rows[i][1], table))
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-total)))
    long = spark.createDataFrame([(0, "ocean light paper " * 70_000 + "you blockhead, you nitwit"), (1, "ocean light paper " * 70_000)], FIELDS)
    assert [r.predicted for r in toxicity.predict(long, model).orderBy("doc_id").collect()] == [1, 0]


def test_odd_rows_have_scores_and_pass_through(spark, docs):
    rows, labels = corpus()
    model = toxicity.fit(spark.createDataFrame(rows, FIELDS), spark.createDataFrame([*labels, (None, 1), (3, None), (0, 0)], "doc_id long, toxic int"), "toxic")
    frame = docs.withColumn("Predicted", F.lit("x")).withColumn("_text", F.lit(1))
    out = toxicity.predict(frame, model)
    assert out.columns == [c for c in frame.columns if c not in ("score", "Predicted")] + ["score", "predicted"]
    got = out.collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = {round(r.score, 12) for r in got if not (r.text or "").strip()}
    assert len(empty) == 1
    assert len({round(r.score, 12) for r in got if r.text == "One two three four five six seven."}) == 1
    bad = spark.sql("SELECT 1L AS doc_id, cast(x'616263ff646566' AS string) AS text")
    assert 0 <= toxicity.predict(bad, model).first().score <= 1


def test_without_labels_or_with_one_kind(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], FIELDS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.predict(docs, toxicity.fit(docs, none, "toxic")).collect()] == [0.5, 0.5]
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.predict(docs, toxicity.fit(docs, ones, "toxic")).collect()] == [0.75, 0.75]
    empty = spark.createDataFrame([], FIELDS)
    assert toxicity.predict(empty, toxicity.fit(empty, ones, "toxic")).count() == 0


def test_sample_is_bounded_by_rows_not_by_ids(spark):
    one_id = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(7, 1)], "doc_id long, toxic int")
    assert common.labelled_sample(one_id, labels, "toxic", 200, "doc_id", "text").count() < 400
    same = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    assert common.labelled_sample(same, labels, "toxic", 200, "doc_id", "text").count() == 1
