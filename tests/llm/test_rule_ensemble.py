import math
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, rule_ensemble
from millrace.llm.common import labelled_sample


@pytest.fixture(scope="module")
def world(spark):
    random.seed(16)
    words = ["harbour", "ferry", "wind", "light", "coast", "engine", "rail", "noon", "island", "deck"]
    rows, labels = [], []
    for i in range(600):
        good = i % 3 > 0
        if good:
            text = ". ".join(" ".join(f"{random.choice(words)}{random.randrange(40)}" for _ in range(9)).capitalize() for _ in range(6)) + "."
        else:
            text = random.choice([" ".join(["buy"] * 60), " | ".join(random.choices(words, k=40)), "!! ".join(w.upper() for w in random.choices(words, k=40))])
        rows.append((i, text))
        labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string").cache(), spark.createDataFrame(labels, "doc_id long, quality int").cache()


def test_learns_and_holds_out(world):
    docs, labels = world
    model = rule_ensemble.fit(docs, labels.where("doc_id % 5 <> 0"), "quality")
    assert model.rules and all(w for _, w in model.rules)
    got = rule_ensemble.predict(docs, model).join(labels, "doc_id").where("doc_id % 5 = 0")
    assert got.where("predicted = quality").count() / got.count() > 0.97
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_scoring_runs_no_python(world):
    docs, labels = world
    model = rule_ensemble.fit(docs, labels, "quality")
    plan = rule_ensemble.predict(docs, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_labels_that_conflict_or_lack(world, spark):
    docs, _ = world
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert rule_ensemble.fit(docs, none, "quality").intercept == 0.0
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    model = rule_ensemble.fit(docs, one, "quality")
    assert not model.rules and model.intercept > 0
    twice = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0), (2, 1)], "doc_id long, quality int")
    sample = labelled_sample(docs, twice, "quality", 100, "doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted((r._text, r._label) for r in sample.collect()) == sorted([(texts[1], 1.0), (texts[2], 0.0)])


def test_odd_texts_and_columns(docs, world):
    model = rule_ensemble.fit(*world, "quality")
    clashing = docs.withColumn("_words", F.lit(1)).withColumn("_s_chars", F.lit("x")).withColumn("_text", F.lit(2))
    got = rule_ensemble.predict(clashing, model)
    assert set(clashing.columns) <= set(got.columns) and got.count() == docs.count()
    assert got.where("score is null or predicted is null").count() == 0
    assert got.where("_s_chars = 'x' and _words = 1").count() == docs.count()
    assert rule_ensemble.predict(docs.limit(0), model).count() == 0


def brute_statistics(text):
    """The statistics counted in Python, one by one."""
    t = text or ""
    words = [w for w in re.split("[\x20\x09-\x0D]+", t) if w]
    lines = [x for x in t.split("\n") if x.strip(" ")]
    n, m, k = max(1, len(t)), max(1, len(words)), max(1, len(lines))
    kind = lambda c: unicodedata.category(c)
    return {
        "_s_chars": len(t), "_s_words": len(words), "_s_word_length": sum(map(len, words)) / m,
        "_s_upper": sum(kind(c) == "Lu" for c in t) / n, "_s_digits": sum(kind(c)[0] == "N" for c in t) / n,
        "_s_symbols": sum(c in "#*$%&|<>" for c in t) / n, "_s_exclaims": sum(c in "!?" for c in t) / n,
        "_s_bars": t.count("|") / n, "_s_letters": sum(kind(c)[0] == "L" for c in t) / n,
        "_s_distinct_words": math.log1p(len(set(words))) / math.log1p(m),
        "_s_repeats": sum(a == b for a, b in zip(words, words[1:], strict=False)) / m,
        "_s_distinct_lines": len(set(lines)) / k, "_s_line_words": len(words) / k,
        "_s_line_marks": sum(c in ".,;:" for c in t) / n,
    }


def test_statistics_and_rules_are_those_of_brute_force(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = docs.select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text").where("doc_id is not null")
    both = table.unionByName(odd)
    measured, names = rule_ensemble.statistics(both)
    rows = measured.select("text", *names).collect()
    for r in rows:
        want = brute_statistics(r.text)
        assert all(abs(r[n] - want[n]) < 1e-9 for n in names), (r.text[:80] if r.text else r.text, [(n, r[n], want[n]) for n in names if abs(r[n] - want[n]) >= 1e-9])
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = rule_ensemble.fit(table, labels, "quality")
    for r in rule_ensemble.predict(both, model).collect():
        s = brute_statistics(r.text)
        total = model.intercept + sum(w for rule, w in model.rules if all(above < s[n] <= upto for n, above, upto in rule.bounds))
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9 and r.predicted == (r.score >= 0.3)


def test_the_query_is_right_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality").distinct()
    got = queries.op4_rule_ensemble(spark, d)
    assert got.count() == spark.read.parquet(f"{d}/documents.parquet").count()
    held = got.where("held_out").join(labels, "doc_id")
    assert held.where("predicted = quality").count() >= 0.95 * held.count() > 0


def test_names_in_other_cases_are_replaced(world, spark):
    docs, labels = world
    model = rule_ensemble.fit(docs, labels, "quality")
    got = rule_ensemble.predict(docs.withColumn("Score", F.lit("x")).withColumn("PREDICTED", F.lit("y")), model)
    assert sorted(c.lower() for c in got.columns) == ["doc_id", "predicted", "score", "text"]
    assert got.where("score < 0 or score > 1").count() == 0
