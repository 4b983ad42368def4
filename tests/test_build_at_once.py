"""A record's rows meet in one group, models are made once however many ask, and a history only as far as it is read."""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import functions as F

from millrace.models import build, history
from millrace.models.build import Build, Run, together
from millrace.operators.hashes import Aggregate, Child, aggregate_hashes
from millrace.sources.versions import Store

FS, GS, RS, US = map(chr, (28, 29, 30, 31))


def test_roots_and_children_are_sent_out_once(spark):
    frames = {
        # two roots with one key, one without children, one without a key
        "root": spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, n long"),
        "one": spark.createDataFrame([("a", "y"), ("a", "x"), ("z", "w"), (None, "v")], "k string, t string"),
        "two": spark.createDataFrame([("a", "a"), ("b", "a"), (None, "b")], "p string, q string"),
    }
    got = aggregate_hashes(Aggregate("e", "root", "k", (Child("one", ("k",)), Child("two", ("p", "q"))), outside_content=("n",)), frames)
    one, two = ["one" + RS + f"va{US}v{t}" for t in "xy"], ["two" + RS + t for t in (f"va{US}va", f"vb{US}va", f"n{US}vb")]
    again = lambda lines: FS.join(x for x in sorted(lines) for _ in range(2))
    texts = {"a": FS + again(one) + FS + again(two[:2]), "b": FS + FS + FS.join(sorted([two[1], two[2]])), None: FS + FS}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    key = lambda k: "n" if k is None else "v" + k
    want = {(k, sha(f"e{GS}root{RS}{key(k)}{US}v{n}{texts[k]}"), sha(f"e{GS}root{RS}{key(k)}{texts[k]}")) for k, n in (("a", 1), ("a", 2), ("b", 3), (None, 4))}
    assert {(r.entity_key, r.row_hash, r.content_hash) for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate [") == 1, plan


def test_a_model_is_made_once_however_many_ask(spark, monkeypatch):
    calls = []

    def slow(b):
        calls.append(1)
        time.sleep(0.3)
        return b.spark.range(1)

    monkeypatch.setitem(build.MODELS, "slow", slow)
    b = Build(spark, Run(1, "r", "2024-01-10T00:00:00Z"), {}, {})
    frames = [df for _, df in together((str(i), lambda: b["slow"]) for i in range(4))]
    assert len(calls) == 1 and all(df is frames[0] for df in frames)
    assert b.frames(["slow", "stg_element"])["slow"] is frames[0]


def test_a_history_is_written_as_far_as_it_is_read(spark, tmp_path):
    first = Build(spark, Run(1, "r", "2024-01-10T00:00:00Z"), {}, {}, str(tmp_path / "1"))
    store = Store(spark, str(tmp_path / "history"))
    past = history.Past(first, store)
    second = Build(spark, Run(2, "s", "2024-02-10T00:00:00Z"), {}, past, str(tmp_path / "2"))
    assert second.prev("transform_run").collect() == [(1, "2024-01-10T00:00:00Z")]
    assert set(store.snapshot().tables) == {"transform_run"} and "int_changes" not in first.made
    assert second.prev("population").where("run_id = 'r'").agg(F.sum("value")).first()[0] == 0
    assert set(past) == {*history.ADDED, "entity_current"} and set(store.snapshot().tables) == {"population", "transform_run"}
