import pytest

from millrace.operators import releases

GOOD_M = {
    "revision": 9, "minimum_revision": 7, "snapshot_only": False, "snapshot": "snapshots/9.sqlite.gz", "lineage": "lineage/9.json.gz", "base": ("icons/base-9.zip", 1),
    "updates": [(7, "updates/7-9.json.gz"), (8, "updates/8-9.json.gz")], "deltas": [(8, "icons/delta-8-9.zip", "s8")], "icon_entities": 3, "icon_count": 3,
}
OPS = [
    ("UPSERT", "equipment", "e1", 9, None, "e1", None, [("e1", "x"), ("y", "e1")]), ("RETIRE", "equipment", "r1", 9, None, None, None, None), ("ALIAS", "equipment", "r1", 9, "e1", None, None, None),
    ("UPSERT", "uid_alias", "r1", 9, None, "r1", 9, None), ("DELETE", "proc", "p", 9, None, None, None, None),
]
GOOD_P = {"from_revision": 8, "to_revision": 9, "added": ["h2", "h1"], "pack": "icons/delta-8-9.zip", "pack_sha256": "s8", "ops": OPS}
GOOD_K = [
    {"path": "icons/delta-8-9.zip", "name": "delta-8-9.zip", "pack_type": "delta", "to_revision": 9, "icons": [("item", "h1", "item/h1.png"), ("item", "h2", "item/h2.png")]},
    {"path": "icons/base-9.zip", "name": "base-9.zip", "pack_type": "base", "to_revision": 9, "icons": [("item", "h0", "item/h0.png")]},
]


def found(spark, manifest=None, package=None, packs=None, more=()):
    ms = [] if manifest is False else [{**GOOD_M, **(manifest or {})}]
    ps = [{**GOOD_P, **(package or {})}, *[{**GOOD_P, **m} for m in more]]
    frames = [spark.createDataFrame([tuple(x[f.split()[0]] for f in names) for x in rows], schema) for rows, names, schema in (
        (ms, [*GOOD_M], releases.MANIFEST), (ps, [*GOOD_P], "from_revision long, to_revision long, added array<string>, pack string, pack_sha256 string, " + releases.PACKAGE.split("pack_sha256 string,")[1]),
        (GOOD_K if packs is None else packs, [*GOOD_K[0]], releases.PACK),
    )]
    return sorted((r.rule, r.subject, r.breach) for r in releases.breaches(*frames).collect())


def ops(**changes):
    """The operations with some fields of one of them changed."""
    at = changes.pop("at")
    names = ("op", "entity", "key", "rev", "to", "uid", "since", "ends")
    return [tuple(changes.get(n, v) for n, v in zip(names, op, strict=True)) if i == at else op for i, op in enumerate(OPS)]


def pack(at, **changes):
    return [{**k, **changes} if i == at else k for i, k in enumerate(GOOD_K)]


def test_a_good_release_breaks_nothing(spark):
    assert found(spark) == []
    alone = {"snapshot_only": True, "minimum_revision": 9, "updates": None, "deltas": []}
    assert found(spark, alone, {"to_revision": 10, "from_revision": 9, "added": None, "pack": None, "pack_sha256": None, "ops": None}, pack(0, to_revision=9)) == [("INV-6", "9-10", "package outside the window")]


@pytest.mark.parametrize(
    ("manifest", "want"),
    [
        ({"snapshot": "snapshots/8.sqlite.gz"}, [("INV-4", "snapshot", "path")]),
        ({"lineage": None}, [("INV-4", "lineage", "path")]),
        ({"updates": [(7, "updates/7-9.json.gz"), (8, "updates/8-8.json.gz")]}, [("INV-4", "8", "update path")]),
        ({"updates": [(8, "updates/8-9.json.gz")]}, [("INV-4", "manifest", "window")]),
        ({"updates": [(8, "updates/8-9.json.gz"), (7, "updates/7-9.json.gz")]}, [("INV-4", "manifest", "window")]),
        ({"snapshot_only": True}, [("INV-4", "manifest", "minimum of a snapshot-only release"), ("INV-4", "manifest", "packages of a snapshot-only release")]),
        ({"icon_count": 4}, [("INV-9", "manifest", "icon count")]),
        ({"deltas": [(8, "icons/delta-8-9.zip", "s8"), (5, "icons/delta-5-9.zip", "s")]}, [("INV-5", "5", "delta without update")]),
        ({"base": ("icons/base-9.zip", 2)}, [("INV-8", "icons/base-9.zip", "icon count")]),
        ({"deltas": []}, [("INV-7", "8-9", "icons without a pack")]),
        ({"deltas": [(8, "icons/delta-8-9.zip", "other")]}, [("INV-7", "8-9", "another pack than the manifest's")]),
    ],
)
def test_manifests(spark, manifest, want):
    assert found(spark, manifest) == want


@pytest.mark.parametrize(
    ("package", "want"),
    [
        ({"ops": ops(at=0, uid="e2")}, [("8-9 UPSERT equipment e1", "payload of another key")]),
        ({"ops": ops(at=0, ends=[("e1", "x"), ("y", "z")])}, [("8-9 UPSERT equipment e1", "link that misses its key")]),
        ({"ops": ops(at=2, to="r1")}, [("8-9 ALIAS equipment r1", "alias to itself")]),
        ({"ops": ops(at=3, since=8)}, [("8-9 UPSERT uid_alias r1", "payload from outside the package")]),
        ({"ops": ops(at=4, rev=8)}, [("8-9 DELETE proc p", "operation outside the package")]),
        ({"ops": [*OPS, OPS[4]]}, [("8-9 DELETE proc p", "operation twice")]),
        ({"ops": [OPS[2], OPS[1]]}, [("8-9 ALIAS equipment r1", "alias before its retirement")]),
        ({"ops": None}, []),
    ],
)
def test_packages(spark, package, want):
    assert found(spark, package=package) == [("INV-6", *w) for w in want]


@pytest.mark.parametrize(
    ("packs", "want"),
    [
        (pack(0, name="x.zip"), [("INV-8", "icons/delta-8-9.zip", "name")]),
        (pack(0, to_revision=8), [("INV-8", "icons/delta-8-9.zip", "revision")]),
        (pack(0, icons=[("item", "h1", "item/h1.png"), ("item", "h2", "gear/h2.png")]), [("INV-8", "icons/delta-8-9.zip h2", "member path")]),
        (pack(0, icons=[("item", "h1", "item/h1.png")]), [("INV-7", "8-9", "other icons than the index's")]),
        (GOOD_K[1:], [("INV-7", "8-9", "no index of the pack")]),
    ],
)
def test_packs(spark, packs, want):
    assert found(spark, packs=packs) == want


def test_packages_without_a_manifest(spark):
    assert ("INV-6", "8-9", "package outside the window") in found(spark, False)
