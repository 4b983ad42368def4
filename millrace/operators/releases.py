"""What must hold between a release's manifest, its update packages and its icon packs, over any number of releases.

Manifests, packages and pack indexes are nested records, one row each; their lists are exploded and met by equality joins
on revisions, paths and keys, so every rule is a plan over all releases, and every breach is a row.

    manifest  revision, minimum_revision, snapshot_only, snapshot, lineage (paths), base (path, icon_count),
              updates (from_revision, path), deltas (from_revision, path, sha256), icon_entities, icon_count
    package   from_revision, to_revision, added (hashes), pack, pack_sha256,
              ops (op, entity, key, rev, to, uid, since, ends: an UPSERT's own key, since when it holds, and for each of its
              links both ends)
    pack      path, name, pack_type, to_revision, icons (kind, sha256, path)

Defined cases: a null list is empty; a null where a rule compares breaks that rule; a package whose release has no manifest
breaks the window rule; a pack that no manifest names belongs to the release it says; tables without rows break nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANIFEST = """revision long, minimum_revision long, snapshot_only boolean, snapshot string, lineage string, base struct<path: string, icon_count: long>,
 updates array<struct<from_revision: long, path: string>>, deltas array<struct<from_revision: long, path: string, sha256: string>>, icon_entities long, icon_count long"""
PACKAGE = """from_revision long, to_revision long, added array<string>, pack string, pack_sha256 string,
 ops array<struct<op: string, entity: string, key: string, rev: long, to: string, uid: string, since: long, ends: array<struct<from_uid: string, to_uid: string>>>>"""
PACK = "path string, name string, pack_type string, to_revision long, icons array<struct<kind: string, sha256: string, path: string>>"

# Where a release's files lie.
SNAPSHOT, LINEAGE, BASE = "snapshots/{n}.sqlite.gz", "lineage/{n}.json.gz", "icons/base-{n}.zip"
UPDATE, DELTA, MEMBER = "updates/{a}-{n}.json.gz", "icons/delta-{a}-{n}.zip", "{kind}/{sha256}.png"


def path(shape: str, **parts: str | Column) -> Column:
    """The shape with columns for its names."""
    made, rest = [], shape
    while rest:
        text, found, rest = rest.partition("{")
        made.append(F.lit(text))
        if found:
            name, _, rest = rest.partition("}")
            c = parts[name]
            made.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.concat(*made)


def _not(c: Column) -> Column:
    """Where a condition doesn't hold, or can't be told."""
    return ~F.coalesce(c, F.lit(False))


def _told(df: DataFrame, revision: str, *checks: tuple[str, Column, Column | str, str]) -> DataFrame:
    """A row for each check (rule, whether it is broken, subject, what) that a row breaks; the frame is read once for all."""
    kind = "struct<rule: string, subject: string, breach: string>"
    found = [F.when(broken, F.struct(F.lit(rule).alias("rule"), subject.cast("string").alias("subject"), F.lit(what).alias("breach"))).cast(kind) for rule, broken, subject, what in checks]
    return df.select(F.col(revision).alias("revision"), F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x")).select("revision", "x.*")


def _list(df: DataFrame, column: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(column).alias("x")).select(*keep, "x.*")


def windows(manifests: DataFrame) -> Iterable[DataFrame]:
    """Paths carry the revision; updates reach back to the oldest supported one without a gap; a snapshot-only release has none."""
    whole, alone = F.lit("manifest"), F.coalesce("snapshot_only", F.lit(False))
    none = F.array().cast("array<bigint>")
    froms = F.coalesce(F.transform("updates", lambda u: u["from_revision"]), none)
    some = (F.size(froms) > 0) | (F.size(F.coalesce("deltas", F.array())) > 0)
    span = F.when(F.col("minimum_revision") < F.col("revision"), F.sequence("minimum_revision", F.col("revision") - 1)).otherwise(none)
    yield _told(
        manifests, "revision",
        *[("INV-4", _not(F.col(c) == path(shape, n="revision")), F.lit(c.split(".")[0]), "path") for c, shape in (("snapshot", SNAPSHOT), ("lineage", LINEAGE), ("base.path", BASE))],
        ("INV-4", alone & _not(F.col("minimum_revision") == F.col("revision")), whole, "minimum of a snapshot-only release"),
        ("INV-4", alone & some, whole, "packages of a snapshot-only release"),
        ("INV-4", ~alone & _not(froms == span), whole, "window"),
        ("INV-9", _not(F.col("icon_entities") == F.col("icon_count")), whole, "icon count"),
    )
    updates = _list(manifests, "updates", "revision")
    yield _told(updates, "revision", ("INV-4", _not(F.col("path") == path(UPDATE, a="from_revision", n="revision")), F.col("from_revision"), "update path"))


def deltas_of(manifests: DataFrame) -> DataFrame:
    return _list(manifests, "deltas", "revision")


def deltas(manifests: DataFrame) -> Iterable[DataFrame]:
    """An icon pack between two revisions goes with an update between them."""
    have = _list(manifests, "updates", "revision").select("revision", "from_revision", F.lit(True).alias("_there")).distinct()
    found = deltas_of(manifests).join(have, ["revision", "from_revision"], "left")
    yield _told(
        found, "revision",
        ("INV-5", F.col("_there").isNull(), F.col("from_revision"), "delta without update"),
        ("INV-5", _not(F.col("path") == path(DELTA, a="from_revision", n="revision")), F.col("from_revision"), "delta path"),
    )


def packages(manifests: DataFrame, found: DataFrame) -> Iterable[DataFrame]:
    """A package lies in its release's window, and so does each of its operations; no operation comes twice, and payloads
    belong to the key they are sent under."""
    at = manifests.select(F.col("revision").alias("to_revision"), "minimum_revision")
    name = F.concat_ws("-", "from_revision", "to_revision")
    inside = (F.col("minimum_revision") <= F.col("from_revision")) & (F.col("from_revision") < F.col("to_revision"))
    yield _told(found.drop("ops").join(at, "to_revision", "left"), "to_revision", ("INV-6", _not(inside), name, "package outside the window"))
    ops = found.select("from_revision", "to_revision", F.posexplode("ops").alias("at", "x")).select("from_revision", "to_revision", "at", "x.*")
    ops = ops.withColumn("who", F.concat_ws(" ", name, "op", "entity", "key"))
    who, key, upsert = F.col("who"), F.col("key"), F.col("op") == "UPSERT"
    dated = F.col("entity").isin("uid_retired", "uid_alias")
    within = lambda c: (F.col(c) > F.col("from_revision")) & (F.col(c) <= F.col("to_revision"))
    apart = F.coalesce(F.exists("ends", lambda e: _not((e["from_uid"] == key) | (e["to_uid"] == key))), F.lit(False))
    yield _told(
        ops, "to_revision",
        ("INV-6", _not(within("rev")), who, "operation outside the package"),
        ("INV-6", (F.col("op") == "ALIAS") & F.col("to").eqNullSafe(key), who, "alias to itself"),
        ("INV-6", upsert & (dated | (F.col("entity") == "equipment")) & _not(F.col("uid") == key), who, "payload of another key"),
        ("INV-6", upsert & dated & _not(within("since")), who, "payload from outside the package"),
        ("INV-6", upsert & (F.col("entity") == "equipment") & apart, who, "link that misses its key"),
    )
    # one shuffle by key for what sets operations of a key beside each other
    met = ops.groupBy("from_revision", "to_revision", "key").agg(
        F.collect_list("who").alias("all"), F.max(F.when(F.col("op") == "RETIRE", F.col("at"))).alias("retired"), F.min(F.when(F.col("op") == "ALIAS", F.struct("at", "who"))).alias("alias")
    )
    twice = met.select("to_revision", F.explode(F.filter(F.array_distinct("all"), lambda w: F.size(F.filter("all", lambda x: x == w)) > 1)).alias("who"))
    yield _told(twice, "to_revision", ("INV-6", F.lit(True), who, "operation twice"))
    yield _told(met, "to_revision", ("INV-6", F.col("retired") > F.col("alias.at"), F.col("alias.who"), "alias before its retirement"))


def icons(manifests: DataFrame, found: DataFrame, packs: DataFrame) -> Iterable[DataFrame]:
    """A package and the manifest name the same icon pack, and the pack's index lists exactly the icons that the package adds."""
    given = deltas_of(manifests).select(F.col("revision").alias("to_revision"), "from_revision", F.col("path").alias("_path"), F.col("sha256").alias("_sha256"))
    name, nothing = F.concat_ws("-", "from_revision", "to_revision"), F.array().cast("array<string>")
    met = found.select("from_revision", "to_revision", "added", "pack", "pack_sha256").join(given, ["to_revision", "from_revision"], "left")
    index = packs.select(F.col("path").alias("_path"), F.sort_array(F.transform(F.coalesce("icons", F.array().cast(packs.schema["icons"].dataType)), lambda i: i["sha256"])).alias("_has"), F.lit(True).alias("_there"))
    listed = met.join(index, "_path", "left")
    none, lists = F.col("_path").isNull(), F.coalesce(F.size("added") > 0, F.lit(False)) | F.col("pack").isNotNull() | F.col("pack_sha256").isNotNull()
    same = ~none & F.coalesce((F.col("pack") == F.col("_path")) & (F.col("pack_sha256") == F.col("_sha256")), F.lit(False))
    equal = F.sort_array(F.coalesce("added", nothing)) == F.coalesce("_has", nothing)
    yield _told(
        listed, "to_revision",
        ("INV-7", none & lists, name, "icons without a pack"), ("INV-7", ~none & ~same, name, "another pack than the manifest's"),
        ("INV-7", same & F.col("_there").isNull(), name, "no index of the pack"), ("INV-7", same & F.col("_there").isNotNull() & _not(equal), name, "other icons than the index's"),
    )


def indexes(manifests: DataFrame, packs: DataFrame) -> Iterable[DataFrame]:
    """A pack's index agrees with the pack's name, its release and its members."""
    of_base = manifests.select("revision", F.col("base.path").alias("path"), F.col("base.icon_count").alias("counted"), F.lit(True).alias("is_base"))
    of_delta = deltas_of(manifests).select("revision", "path", F.lit(None).cast("long").alias("counted"), F.lit(False).alias("is_base"))
    met = packs.join(of_base.unionByName(of_delta).distinct(), "path", "left").withColumn("release", F.coalesce("revision", "to_revision"))
    base = F.coalesce("is_base", F.lit(False)) & (F.col("pack_type") == "base")
    yield _told(
        met, "release",
        ("INV-8", _not(F.col("name") == F.substring_index("path", "/", -1)), F.col("path"), "name"), ("INV-8", _not(F.col("to_revision") == F.col("release")), F.col("path"), "revision"),
        ("INV-8", base & _not(F.col("counted") == F.size(F.coalesce("icons", F.array()))), F.col("path"), "icon count"),
    )
    members = met.select("release", F.col("path").alias("pack"), F.explode("icons").alias("x")).select("release", "pack", "x.*")
    yield _told(members, "release", ("INV-8", _not(F.col("path") == path(MEMBER, kind="kind", sha256="sha256")), F.concat_ws(" ", "pack", "sha256"), "member path"))


def breaches(manifests: DataFrame, found: DataFrame, packs: DataFrame) -> DataFrame:
    """revision, rule, subject and breach: a row for each fact of a release that breaks a rule; none for a good release."""
    parts = [*windows(manifests), *deltas(manifests), *packages(manifests, found), *icons(manifests, found, packs), *indexes(manifests, packs)]
    return reduce(DataFrame.unionByName, parts)
