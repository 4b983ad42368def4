import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import changes, gate, graph, hashes, lifecycle, naming, quality, selection
from millrace.sources import files, sqlite

STATE = "entity_type string, entity_key string, row_hash string, content_hash string, state string, retired_revision long"


def current(spark, rows):
    return spark.createDataFrame(rows, STATE)


def before(spark, rows):
    return spark.createDataFrame(rows, STATE + ", last_revision long, last_operation string")


CASES = [
    # name, current row or None, previous row or None, wanted operation
    ("new", ("equipment", "a", "r1", "c1", "live", None), None, "INSERT"),
    ("same", ("equipment", "a", "r1", "c1", "live", None), ("r1", "c1", "live", "UPDATE"), None),
    ("changed", ("equipment", "a", "r2", "c2", "live", None), ("r1", "c1", "live", "UPDATE"), "UPDATE"),
    ("retired", ("equipment", "a", "r2", "c1", "retired", 7), ("r1", "c1", "live", "INSERT"), "RETIRE"),
    ("retired and changed", ("equipment", "a", "r2", "c2", "retired", 7), ("r1", "c1", "live", "INSERT"), "UPDATE"),
    ("revived", ("equipment", "a", "r2", "c1", "live", None), ("r1", "c1", "retired", "RETIRE"), "UPDATE"),
    ("deleted before", ("proc", "a", "r1", "c1", None, None), (None, None, None, "DELETE"), "INSERT"),
    ("gone", None, ("r1", "c1", None, "INSERT"), "DELETE"),
    ("gone, not deletable", None, ("r1", "c1", "live", "INSERT"), None),
]


@pytest.mark.parametrize(("name", "now", "was", "want"), CASES, ids=[c[0] for c in CASES])
def test_change_ladder(spark, name, now, was, want):
    kind = now[0] if now else "equipment" if name.endswith("deletable") else "proc"
    old = [] if was is None else [(kind, "a", was[0], was[1], was[2], None, 3, was[3])]
    found = changes.detect_changes(current(spark, [now] if now else []), before(spark, old), ["proc"], revision=F.lit(7)).collect()
    assert [r.operation for r in found] == ([want] if want else [])


def test_failed_pages_defer_all_deletes(spark):
    old = before(spark, [("equipment", "e", "r", "c", "live", None, 3, "INSERT"), ("proc", "p", "r", "c", None, None, 3, "INSERT")])
    now = current(spark, [("equipment", "e", "r", "c", "live", None)])
    find = lambda failed: [r.operation for r in changes.detect_changes(now, old, ["proc"], revision=F.lit(7), deferred=spark.createDataFrame(failed, "source_id string")).collect()]
    assert find([("e",)]) == [] and find([("other",)]) == ["DELETE"] and find([]) == ["DELETE"]


def test_overlay_ignores_aliases_and_appends_once(spark):
    old = before(spark, [("equipment", "e", "r", "c", "live", None, 3, "INSERT")])
    log = spark.createDataFrame([("equipment", "e", "ALIAS", "r", "c", "live", None, 7), ("equipment", "n", "INSERT", "x", "y", "live", None, 7)], "entity_type string, entity_key string, operation string, row_hash string, content_hash string, state string, retired_revision long, revision long")
    after = {r.entity_key: (r.last_revision, r.last_operation) for r in changes.overlay(old, log).collect()}
    assert after == {"e": (3, "INSERT"), "n": (7, "INSERT")}
    ledger = spark.createDataFrame([(1, "a")], "k int, v string")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    once = changes.append_new(ledger, rows, ["k"])
    assert [r.k for r in once.collect()] == [2]
    assert changes.append_new(ledger.union(once), rows, ["k"]).count() == 0


def test_net_operations(spark):
    log = [("a", "INSERT", 1), ("a", "DELETE", 2), ("b", "UPDATE", 1), ("b", "DELETE", 3), ("c", "RETIRE", 2), ("d", "RETIRE", 1), ("d", "UPDATE", 2), ("e", "ALIAS", 2), ("f", "DELETE", 1), ("f", "INSERT", 2)]
    frame = spark.createDataFrame([("equipment", *r) for r in log] + [("uid_alias", "g", "INSERT", 1), ("uid_alias", "g", "DELETE", 2)], "entity_type string, entity_key string, operation string, revision long")
    assert {r.entity_key: r.operation for r in changes.net_operations(frame, ["uid_alias"]).collect()} == {"b": "DELETE", "c": "RETIRE", "d": "UPSERT", "f": "UPSERT", "g": "UPSERT"}


def test_slowly_changing_is_idempotent(spark):
    schema = "k int, v string, at long, valid_from long, valid_to long"
    history = spark.createDataFrame([(1, "a", 1, 1, None), (2, "x", 1, 1, None)], schema)
    load = spark.createDataFrame([(1, "b", 2), (2, "x", 1), (3, "n", 2)], "k int, v string, at long")
    after = changes.slowly_changing(history, load, "k", "at")
    rows = sorted((r.k, r.v, r.valid_from, r.valid_to) for r in after.fillna(-1).collect())
    assert rows == [(1, "a", 1, 2), (1, "b", 2, -1), (2, "x", 1, -1), (3, "n", 2, -1)]
    assert changes.differences(changes.slowly_changing(after, load, "k", "at"), after).count() == 0


def test_hash_ignores_order_but_not_content(spark):
    root = spark.createDataFrame([("a", "live"), ("b", "live")], "uid string, state string")
    a = hashes.Aggregate("e", "e", "uid", (hashes.Child("s", ("uid",)), hashes.Child("l", ("x", "y"))), outside_content=("state",))
    s = [("a", 1), ("a", 2), ("b", 3)]
    frames = lambda s, state="live": {"e": root.withColumn("state", F.lit(state)), "s": spark.createDataFrame(s, "uid string, v int"), "l": spark.createDataFrame([("a", "a"), ("a", "b")], "x string, y string")}
    get = lambda f: {r.entity_key: (r.row_hash, r.content_hash) for r in hashes.aggregate_hashes(a, f).collect()}
    base = get(frames(s))
    assert get(frames(s[::-1])) == base
    other = get(frames([*s, ("b", 4)]))
    assert other["a"] == base["a"] and other["b"] != base["b"]
    retired = get(frames(s, "retired"))
    assert retired["a"][0] != base["a"][0] and retired["a"][1] == base["a"][1]


def test_table_digest_has_no_order(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    digest = lambda f: hashes.table_digest(f).first().digest
    assert digest(frame.repartition(3)) == digest(frame.orderBy(F.desc("k")).select("v", "k"))
    assert digest(frame) != digest(frame.distinct())
    assert hashes.table_digest(frame.limit(0)).first().rows == 0


def test_chains_cycles_aliases(spark):
    edges = spark.createDataFrame([("k", a, b) for a, b in [("r", "a"), ("a", "b"), ("q", "b"), ("c", "d"), ("d", "c"), ("d", "e"), ("b", "b")]], "kind string, from_uid string, to_uid string")
    assert {r.uid: (r.chain_id, r.position) for r in graph.chains(edges).collect()} == {"r": ("r", 0), "q": ("q", 0), "a": ("r", 1), "b": ("q", 1)}
    assert sorted(r.uid for r in graph.in_cycles(edges).collect()) == ["b", "c", "d"]
    assert graph.in_cycles(edges.where("from_uid = 'r'")).count() == 0
    long = spark.createDataFrame([(i, i + 1) for i in range(50)], "old_uid long, new_uid long")
    assert {r.end_uid for r in graph.alias_ends(long).collect()} == {50}
    with pytest.raises(ValueError, match="cycle"):
        graph.alias_ends(spark.createDataFrame([(1, 2), (2, 1)], "old_uid long, new_uid long"))


def test_null_aware_anti(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = lambda *v: spark.createDataFrame([(x,) for x in v], "o int")
    get = lambda r: [x.k for x in selection.null_aware_anti(left, "k", r, "o").collect()]
    assert get(keys(1)) == [2] and get(keys(1, None)) == [] and len(get(keys())) == 3


def test_streaks(spark):
    runs = spark.createDataFrame([(r,) for r in range(1, 6)], "run int")
    hits = spark.createDataFrame([("a", r) for r in (1, 2, 4, 5)] + [("b", r) for r in range(1, 6)] + [("c", 3)] + [("d", 5), ("d", 5)], "k string, run int")
    assert {r.k: r.runs for r in selection.streaks(runs, hits, "k", "run").collect()} == {"a": 2, "b": 5, "d": 1}


def test_containment_refuses_large_words(spark, monkeypatch):
    monkeypatch.setattr(selection, "SMALL_ROWS", 1)
    words = spark.createDataFrame([("a",), ("b",)], "w string")
    with pytest.raises(ValueError, match="more than 1"):
        selection.containment_join(words, "w", words, "w")


NAMES = [
    ("fire storm 2xl+", "2xl+", "fire storm", "fire", "prefix", "storm"), ("storm fire", None, "storm fire", "fire", "suffix", "storm"),
    ("great fire wind storm", None, "great fire wind storm", "fire", "infix", "great storm"), ("fire", None, "fire", "fire", "prefix", "fire"),
    ("storm S", "s", "storm", None, None, "storm"), ("bonfire m", "m", "bonfire", None, None, "bonfire"), ("xl", None, "xl", None, None, "xl"),
]


@pytest.mark.parametrize("case", NAMES, ids=[n[0] for n in NAMES])
def test_names(spark, case):
    r = naming.decompose(spark.createDataFrame([(case[0],)], "n string"), "n", ["fire", "wind"]).first()
    assert (r.size, r.base_name, r.name_element, r.element_position, r.family_name) == case[1:]


def test_scaling_line(spark):
    line = "ability power scales with the number of water elemental weapons equipped up to a max of 5xl+ (gear pieces needed for maximum effect: 5)."
    r = naming.scaling(spark.createDataFrame([(line,)], "n string"), "n", ["water"]).first()
    assert (r.scale_kind, r.element_id, r.gear_kind, r.cap, r.pieces_needed) == ("ability_power", "water", "weapons", "5xl+", 5)
    r = naming.scaling(spark.createDataFrame([("unclear",)], "n string"), "n", ["water"]).first()
    assert (r.scale_kind, r.element_id, r.gear_kind, r.cap, r.pieces_needed) == ("unknown", None, "gear", None, None)


def test_scope(spark):
    scope = lifecycle.Scope(42, 98, 99, ("UR",), ("xeno",), ("test",))
    rows = [("a test xeno", "UR", 50), ("b", "UR", 99), ("Xeno c", "SR", 10), ("d", "SR", 50), ("e", "UR", 42), ("f", "UR", 41)]
    got = [(r.reason, r.keep) for r in lifecycle.decide_scope(spark.createDataFrame(rows, "name string, rarity string, cost int").coalesce(1), scope).collect()]
    assert got == [("excluded_name", False), ("cosmetic", False), ("name_token", True), ("rarity", False), ("cost_band", True), ("cost", False)]


POLICY = """
[check.c]
scopes = { catalog = "warning", new_item = "info" }
escalate = { scope = "catalog", level = "blocker", min_count = 2, min_pct = 10.0 }
[check.r]
scopes = { catalog = "info" }
escalate = { scope = "catalog", level = "blocker", min_runs = 3 }
"""


def gate_rows(spark, rows):
    return spark.createDataFrame(rows, "check string, entity_type string, entity_key string, entry_kind string, is_new_item boolean, affected long, runs long, detail string")


def test_gate(spark):
    policy = gate.Policy.parse(POLICY).frame(spark)
    population = spark.createDataFrame([("catalog", 20)], "scope string, value long")
    row = lambda check, key, new=False, affected=1, runs=None: (check, "e", key, "catalog", new, affected, runs, None)
    find = lambda rows, pop=population: {(r.check, r.scope, r.escalated): (r.level, r["count"]) for r in gate.findings(gate_rows(spark, rows), policy, pop).collect()}
    assert find([row("c", "a")]) == {("c", "catalog", False): (1, 1)}
    assert find([row("c", "a"), row("c", "a"), row("c", "b")]) == {("c", "catalog", True): (2, 2)}
    assert find([row("c", "a"), row("c", "b")], population.limit(0)) == {("c", "catalog", False): (1, 2)}
    assert find([row("c", "a", new=True)]) == {("c", "new_item", False): (0, 1)}
    assert find([row("r", "a", runs=3), row("r", "b", runs=1), row("r", "d")]) == {("r", "catalog", True): (2, 1), ("r", "catalog", False): (0, 2)}
    decided = gate.decide(gate.findings(gate_rows(spark, [row("c", "a")]), policy, population)).first()
    assert (decided.decision, decided.publishable, decided.findings) == ("warning", True, 1)
    assert gate.decide(gate.findings(gate_rows(spark, []), policy, population)).first().decision == "pass"


def test_policy_is_checked():
    assert gate.Policy.parse(POLICY).fingerprint == gate.Policy.parse(POLICY + "\n# note").fingerprint
    for bad in ('scopes = { catalog = "loud" }', "escalate = {}", 'scopes = { catalog = "info" }\nextra = 1', 'scopes = { catalog = "info" }\nescalate = { scope = "new_item", level = "info" }'):
        with pytest.raises(ValueError):
            gate.Policy.parse(f"[check.c]\n{bad}")


def test_expectations(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, 5)], "k int, v string, p int")
    parent = spark.createDataFrame([(4,)], "id int")
    assert quality.unique(frame, "k").count() == 1 and quality.unique_combination(frame, ["v", "p"]).count() == 1
    assert quality.accepted_values(frame, "v", ["b"]).first().n == 2 and quality.not_null(frame, "v", F.col("k") == 1).count() == 0
    assert quality.relationships(frame, "p", parent, "id").count() == 1
    assert quality.polymorphic_relationship(frame, "v", "a", "p", None, None).count() == 2
    run = quality.run_expectations([quality.Expectation("k", quality.unique(frame, "k")), quality.Expectation("v", quality.not_null(frame, "v"), "info")], str(tmp_path))
    assert [(r.name, r.failures) for r in run.orderBy("name").collect()] == [("k", 1), ("v", 1)]
    assert spark.read.parquet(str(tmp_path / "k")).count() == 1


def test_sqlite_source_prunes_and_checks(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"n{i}", i / 2, b"\x00") for i in range(50)], "k long, n string, v double, b binary").repartition(3)
    at = str(tmp_path / "t")
    sqlite.write(frame, at, "t")
    assert sorted(map(tuple, sqlite.read(spark, at, "t", {"n": "string"}).collect())) == sorted((f"n{i}",) for i in range(50))
    assert sqlite.read(spark, at, "t").dtypes == frame.dtypes
    sqlite.write(frame.limit(2), at, "t")
    assert sqlite.read(spark, at, "t").count() == 2
    with pytest.raises(Exception, match="no such table"):
        sqlite.read(spark, at, "other").count()


def test_stored_pages_are_verified(spark):
    pages = spark.createDataFrame([(1, "<p>é"), (2, None)], "page_id long, html string")
    stored = files.store_pages(pages, "page_id", "html")
    assert [(r.page_id, r.html) for r in files.read_pages(stored, "page_id").collect()] == [(1, "<p>é")]
    with pytest.raises(Exception, match="hash"):
        files.read_pages(stored.withColumn("sha", F.lit("0")), "page_id").collect()


def test_files_refuse_what_does_not_fit(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"k": 1}\n{"k": "no"}\n')
    with pytest.raises(Exception, match="(?i)malformed|fail"):
        files.read_ndjson(spark, str(tmp_path / "x.json"), "k long").collect()


def test_published_revisions_stay(spark, tmp_path):
    at = str(tmp_path / "p")
    files.publish(spark.range(3), at, 1)
    files.publish(spark.range(5), at, 2)
    assert files.current_revision(spark, at) == 2 and files.read_current(spark, at).count() == 5
    with pytest.raises(Exception, match="(?i)exist"):
        files.publish(spark.range(1), at, 2)


def test_package_needs_no_text_operators():
    import ast
    from pathlib import Path

    root = Path(__file__).parent.parent / "millrace"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any(n.startswith("millrace.llm") for n in names), path


def test_keys_between_cycles_are_not_on_one(spark):
    pairs = [("a", "b"), ("b", "a"), ("b", "m"), ("m", "c"), ("c", "d"), ("d", "c"), ("s", "s"), ("x", "a"), ("d", "y"), ("p", "q"), ("q", "r"), ("r", "p"), ("r", "q")]
    edges = spark.createDataFrame([("k", *p) for p in pairs] + [("other", "m", "m")], "kind string, from_uid string, to_uid string")
    got = sorted((r.kind, r.uid) for r in graph.in_cycles(edges).collect())
    assert got == [("k", u) for u in "abcdpqrs"] + [("other", "m")]
    assert graph.in_cycles(edges.limit(0)).count() == 0


@pytest.mark.parametrize("escalate", ['scope = "catalog", level = "blocker", min_count = 3', 'scope = "catalog", level = "blocker", min_pct = 3.0', 'scope = "catalog", level = "blocker", min_count = 3, min_pct = 1.0, min_runs = 2', 'scope = "catalog", level = "info", min_runs = 2', 'scope = "catalog", level = "blocker", min_count = 0, min_pct = 1.0', 'scope = "catalog", level = "blocker", min_count = 1, min_pct = 101', 'scope = "other", level = "blocker", min_runs = 2', ""])
def test_escalations_that_make_no_sense(escalate):
    with pytest.raises(ValueError):
        gate.Policy.parse(f'[check.a]\nscopes = {{ catalog = "warning" }}\nescalate = {{ {escalate} }}')


def test_shares_are_compared_exactly_and_unknown_checks_are_told(spark):
    policy = gate.Policy.parse('[check.a]\nscopes = { catalog = "warning" }\nescalate = { scope = "catalog", level = "blocker", min_count = 1, min_pct = 2.0 }').frame(spark)
    rows = [("equipment", "k1", "catalog", False, 19_999_999, None, "a"), ("equipment", "k2", "catalog", False, -5, None, "a"), ("equipment", "k3", "reference", False, 1, None, "a"), ("equipment", "k4", None, True, 1, 2, "unknown")]
    frame = spark.createDataFrame(rows, "entity_type string, entity_key string, entry_kind string, is_new_item boolean, affected long, runs long, check string")
    population = spark.createDataFrame([("catalog", 1_000_000_000)], "scope string, value long")
    got = {(r.check, r.scope): (r.level, r.escalated, r.affected) for r in gate.findings(frame, policy, population).collect()}
    assert got == {("a", "catalog"): (1, False, 19_999_999), ("a", "reference"): (0, False, 1), ("unknown", "catalog"): (0, False, 1)}
    more = population.withColumn("value", F.lit(999_999_950))
    assert gate.findings(frame.where("check = 'a'"), policy, more).where("scope = 'catalog'").first().level == 2


def test_a_run_is_decided_once(spark, tmp_path):
    policy = gate.Policy.parse('[check.canary]\nscopes = { catalog = "warning" }').frame(spark)
    assert [gate.canary_finding(policy, x).count() for x in (True, None, False)] == [1, 1, 0]
    found = gate.canary_finding(policy, True).withColumn("consecutive_runs", F.lit(1))
    gate.record(found, str(tmp_path), "r1")
    with pytest.raises(ValueError):
        gate.record(found, str(tmp_path), "r1")
    gate.record(found, str(tmp_path), "r2")
    with pytest.raises(Exception, match="stopped"):  # findings are written, then the job stops before the decision
        gate.merged(found).withColumn("run_id", F.lit("7")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{tmp_path}/gate_finding")
        raise RuntimeError("stopped")
    assert [r.run_id for r in gate.recorded(spark, str(tmp_path)).orderBy("run_id").collect()] == ["r1", "r2"]
    gate.record(found, str(tmp_path), "7")
    assert [r.run_id for r in gate.recorded(spark, str(tmp_path)).orderBy("run_id").collect()] == ["7", "r1", "r2"]
    assert gate.recorded(spark, f"{tmp_path}/none").count() == 0
    spark.read.schema(gate.DECISION).parquet(f"{tmp_path}/gate_decision").where("run_id <> '7'").write.parquet(f"{tmp_path}/other/gate_decision")
    assert spark.read.parquet(f"{tmp_path}/other/gate_decision").where("decision = 'warning' AND publishable").count() == 2
    results = spark.createDataFrame([("a", "info", "warn", 3, None), ("b", "structural", "fail", 0, "m"), ("c", "policy", "warn", 1, None), ("d", "contract", "pass", 0, None), ("e", "contract", "warn", 2, None)], "name string, grp string, status string, failures long, message string")
    told = gate.ordered(gate.run_findings(results)).collect()
    assert [(r.check, r.level, r.affected, r.message) for r in told] == [("run", 3, 1, "b fail m"), ("a", 0, 3, "a: 3 rows"), ("e", 0, 2, "unclassified warning e")]
    assert gate.decide(gate.run_findings(results)).first().decision == "error"


def test_containment_by_token(spark):
    df = spark.createDataFrame([(1, "a b c a"), (2, "ab c"), (3, None), (4, "b c")], "id long, text string")
    words = spark.createDataFrame([("a",), ("b c",), ("zz",)], "word string")
    want = sorted(map(tuple, selection.containment_join(df, "text", words, "word").collect()))
    assert sorted(map(tuple, selection.containment_by_token(df, "text", words, "word").collect())) == want and want


def test_findings_are_ordered(spark):
    rows = [("b", "catalog", 1, False, "x", "m"), ("a", "reference", 1, True, "x", "m"), ("a", "catalog", 1, True, "y", "m"), ("a", "catalog", 1, True, "x", "n"), ("a", "catalog", 1, False, "z", "m"), ("z", "all", 3, False, "", "m"), ("a", "catalog", 0, False, "", "m"), ("a", "catalog", 1, True, "x", "m")]
    frame = spark.createDataFrame(rows, "check string, scope string, level int, escalated boolean, sources string, message string").repartition(4)
    assert [tuple(r) for r in gate.ordered(frame).collect()] == sorted(rows, key=lambda r: (-r[2], *r[:2], *r[3:]))


def test_a_published_catalogue_is_compared_with_what_is_shipped():
    found = {"a": ["x", "y"], "b": ["x"], "d": []}
    assert quality.shipped_faults(found, {"a": ["x", "z"], "b": ["x"], "c": ["x"]}) == [("c", "missing"), ("d", "unexpected"), ("a", "missing column z"), ("a", "unexpected column y")]


def test_replacements_are_those_of_all_pairs(spark):
    rng = random.Random(6)
    items = [(f"p{i}", rng.choice("ab"), rng.choice(["x", None])) for i in range(60)]
    cells = [(u, rng.choice("hm"), rng.choice(["i", None]), rng.randrange(3)) for u, *_ in items if rng.random() < 0.8 for _ in range(rng.randrange(6))] + [("p1", None, "i", 1)]
    have = {u: {(a, b, c) for v, a, b, c in cells if v == u and a is not None} for u, *_ in items}
    old, new = items[:30], items[25:]
    frames = [spark.createDataFrame(x, "uid string, name string, kind string") for x in (old, new)]
    stats = spark.createDataFrame(cells, "uid string, label string, tier string, value int")
    for score in (0.34, 0.75, 1.0, 0.0):
        want = {}
        for u, n, k in old:
            for v, m, l in new:
                if u != v and n == m and k is not None and k == l:
                    both = have[u] | have[v]
                    s = len(have[u] & have[v]) / len(both) if both else 1.0
                    if s >= score:
                        want[u, v] = round(s, 9)
        got = lifecycle.replacements(*frames, stats, ["name", "kind"], score).collect()
        assert {(r.old_uid, r.new_uid): round(r.score, 9) for r in got} == want and len(got) == len(want)
