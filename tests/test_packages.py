import pytest
from pyspark.sql import functions as F

from millrace.operators import packages
from millrace.operators.packages import Part, Reference, Whole

ITEM = Whole("item", "item", "uid", (Part("stat", ("uid",), ("label",)), Part("edge", ("a", "b"), ("a", "b")), Part("note", ("uid",), single=True)))
PROC = Whole("proc", "proc", "pid", (Part("step", ("pid",)),))


@pytest.fixture
def frames(spark):
    def make(items=(), stats=(), edges=(), notes=(), procs=(), steps=()):
        return {
            "item": spark.createDataFrame(list(items), "uid string, cost int, state string, retired_revision long, proc string"), "stat": spark.createDataFrame(list(stats), "uid string, label string, value int"),
            "edge": spark.createDataFrame(list(edges), "a string, b string"), "note": spark.createDataFrame(list(notes), "uid string, text string"),
            "proc": spark.createDataFrame(list(procs), "pid string, name string, base string"), "step": spark.createDataFrame(list(steps), "pid string, n int"),
        }

    return make


def item(uid, cost=1, state="live", retired=None, proc=None):
    return (uid, cost, state, retired, proc)


def operations(spark, *rows):
    return spark.createDataFrame([(e, k, o, 9) for e, k, o in rows], "entity string, key string, operation string, rev long")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_child_of_two_owners_comes_and_goes_once(spark, frames):
    old = frames([item("p"), item("q"), item("r")], edges=[("p", "q"), ("q", "r"), ("p", "p")])
    new = frames([item("p", 2), item("q", 2), item("r")], edges=[("p", "q"), ("q", "p"), ("q", "r")])
    got = packages.apply_package([ITEM], old, operations(spark, ("item", "p", "UPSERT"), ("item", "q", "UPSERT")), new)
    assert rows(got["edge"]) == [("p", "q"), ("q", "p"), ("q", "r")]
    gone = packages.apply_package([ITEM], old, operations(spark, ("item", "q", "DELETE")), new)
    assert rows(gone["edge"]) == [("p", "p")] and rows(gone["item"].select("uid")) == [("p",), ("r",)]


def test_retired_roots_keep_their_children(spark, frames):
    old = frames([item("p"), item("q")], stats=[("p", "hp", 1)])
    got = packages.apply_package([ITEM], old, operations(spark, ("item", "p", "RETIRE"), ("item", "q", "ALIAS")), old)
    assert rows(got["item"].select("uid", "state", "retired_revision")) == [("p", "retired", 9), ("q", "live", None)]
    assert rows(got["stat"]) == [("p", "hp", 1)]


def test_payloads_are_ordered_and_have_a_place_for_what_is_missing(spark, frames):
    f = frames([item("p"), item("q")], stats=[("p", "b", 2), ("p", "a", 1)], edges=[("p", "q"), ("p", "p")], notes=[("p", "n")])
    keys = spark.createDataFrame([("p",), ("q",), ("none",)], "key string")
    got = {r.key: r.data for r in packages.payloads(ITEM, f, keys).collect()}
    assert set(got) == {"p", "q"}
    assert [s.label for s in got["p"].stat] == ["a", "b"] and [(e.a, e.b) for e in got["p"].edge] == [("p", "p"), ("p", "q")] and got["p"].note.text == "n"
    assert got["q"].stat == [] and [(e.a, e.b) for e in got["q"].edge] == [("p", "q")] and got["q"].note is None


def test_positions_have_no_gap_and_ties_go_by_key(spark):
    some = [("item", k, "UPSERT") for k in "dbca"] + [("proc", k, "UPSERT") for k in "ba"] + [("item", "z", "RETIRE"), ("item", "y", "ALIAS"), ("item", "x", "DELETE"), ("proc", "w", "DELETE"), ("proc", "a", "DELETE")]
    got = packages.ordered_operations(operations(spark, *some).repartition(5), ("proc", "item")).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(some)))
    assert [(r.entity, r.key, r.operation) for r in got] == [
        ("proc", "a", "UPSERT"), ("proc", "b", "UPSERT"), *[("item", k, "UPSERT") for k in "abcd"], ("item", "z", "RETIRE"), ("item", "y", "ALIAS"), ("item", "x", "DELETE"), ("proc", "a", "DELETE"), ("proc", "w", "DELETE"),
    ]
    assert packages.ordered_operations(spark.createDataFrame([], "entity string, key string, operation string, rev long"), ("item",)).count() == 0


def test_a_proof_tells_which_table_differs(frames):
    f = frames([item("p")], stats=[("p", "hp", 1), ("p", "mp", 2)])
    g = f | {"stat": f["stat"].withColumn("value", F.when(F.col("label") == "mp", 3).otherwise(F.col("value")))}
    assert {r.table: r.same for r in packages.prove(f, g).collect()} == {n: n != "stat" for n in f}
    twice = f | {"stat": f["stat"].union(f["stat"].limit(1))}
    assert not {r.table: r.same for r in packages.prove(f, twice).collect()}["stat"]
    assert all(r.same for r in packages.prove(f, {n: df.repartition(3) for n, df in f.items()}).collect())


def test_replay_is_proved(spark, frames):
    old = frames([item("p"), item("q"), item("r")], stats=[("p", "hp", 1), ("r", "hp", 3)], notes=[("q", "n")])
    new = frames([item("p", 5), item("q"), item("s")], stats=[("p", "hp", 7)], notes=[("q", "n"), ("s", "m")])
    ops = operations(spark, ("item", "p", "UPSERT"), ("item", "s", "UPSERT"), ("item", "r", "DELETE"))
    assert all(r.same for r in packages.prove(new, packages.apply_package([ITEM], old, ops, new)).collect())
    short = ops.where("key <> 's'")
    assert {r.table for r in packages.prove(new, packages.apply_package([ITEM], old, short, new)).collect() if not r.same} == {"item", "note"}


REFERENCES = [Reference("item", "proc", "proc", "pid"), Reference("proc", "base", "proc", "pid", "name <> 'end'")]


def carried(frames, old, new, failed, rounds=16):
    key = old["item"].sparkSession.createDataFrame([(k,) for k in failed], "key string")
    got = packages.carry_forward(ITEM, new, old, key, [PROC], REFERENCES, rounds)
    return {n: rows(df) for n, df in got.items() if rows(df)}


def test_what_failed_is_carried_with_what_it_refers_to(frames):
    old = frames([item("p", proc="a"), item("q", proc="a"), item("r")], stats=[("p", "hp", 1), ("r", "hp", 2)], edges=[("p", "q"), ("q", "p"), ("r", "r")], procs=[("a", "x", "b"), ("b", "end", "c"), ("c", "y", None)], steps=[("a", 1), ("b", 2), ("c", 3)])
    new = frames([item("r")], procs=[("c", "y", None)])
    got = carried(frames, old, new, ["p", "q", "q", "r", "unknown"])
    assert got["item"] == [item("p", proc="a"), item("q", proc="a")] and got["stat"] == [("p", "hp", 1)] and got["edge"] == [("p", "q"), ("q", "p")]
    assert got["proc"] == [("a", "x", "b"), ("b", "end", "c")] and got["step"] == [("a", 1), ("b", 2)]
    assert carried(frames, old, new, []) == {}


def test_references_that_go_on_too_long_or_round_in_a_circle(frames):
    chain = [(str(i), "x", str(i + 1)) for i in range(6)]
    old, new = frames([item("p", proc="0")], procs=chain), frames()
    with pytest.raises(ValueError, match="deeper than 3"):
        carried(frames, old, new, ["p"], 3)
    assert len(carried(frames, old, new, ["p"], 8)["proc"]) == 6
    ring = frames([item("p", proc="0")], procs=[("0", "x", "1"), ("1", "x", "0")])
    assert len(carried(frames, ring, new, ["p"])["proc"]) == 2


def test_windows_end_at_the_first_gap(spark):
    given = [("a", r, r != 4) for r in (2, 3, 4, 5, 6)] + [("b", r, True) for r in (3, 5, 6)] + [("c", 6, False), ("d", 9, True)]
    frame = spark.createDataFrame(given, "name string, revision long, qualifies boolean")
    assert rows(packages.supported_revisions(frame, ["name"], F.lit(7), 30)) == [("a", 5), ("a", 6), ("b", 5), ("b", 6)]
    assert rows(packages.supported_revisions(frame, ["name"], F.lit(7), 1)) == [("a", 6), ("b", 6)]


@pytest.mark.parametrize(("have", "want"), [(9, "none"), (10, "none"), (4, "snapshot"), (5, "5-9"), (8, "8-9")])
def test_decisions(spark, have, want):
    assert spark.range(1).select(packages.update_decision(F.lit(have), F.lit(9), F.lit(5))).first()[0] == want


def test_reasons_come_in_their_order(spark):
    flags = {"no_base": F.lit(True), "package_size": ~packages.small_enough(F.lit(51), F.lit(100), 0.5), "forced": F.lit(None).cast("boolean"), "first_release": F.lit(False)}
    assert spark.range(1).select(packages.snapshot_only_reasons(flags)).first()[0] == ["package_size", "no_base"]
