"""The release gate: findings of checks, escalated by policy, and the decision."""

from __future__ import annotations

import hashlib
import json
import tomllib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.selection import streaks
from millrace.sources.files import exists

LEVELS = ("info", "warning", "blocker", "error")
#: Keys that a finding names at most, in order.
SAMPLE = 20
#: How expectations that did not run through are called.
BROKEN = ("error", "fail", "skipped", "runtime error")


@dataclass(frozen=True)
class Rule:
    """How a check's rows are judged in one scope."""

    level: str
    escalate_to: str | None = None
    min_count: int = 0
    min_pct: float = 0.0
    min_runs: int | None = None


def _escalation(check: str, up: dict, scopes: dict[str, str]) -> dict:
    """The fields of a rule that an escalation adds; ValueError where it makes no sense."""
    count, pct, runs = (up.get(k) for k in ("min_count", "min_pct", "min_runs"))
    whole = lambda n: isinstance(n, int) and not isinstance(n, bool) and n >= 1
    share = isinstance(pct, (int, float)) and not isinstance(pct, bool) and 0 < pct <= 100
    if set(up) - {"scope", "level", "min_count", "min_pct", "min_runs"} or up.get("scope") not in scopes:
        raise ValueError(f"check.{check}.escalate: unknown key or scope")
    if up.get("level") not in LEVELS[1:3] or LEVELS.index(up["level"]) <= LEVELS.index(scopes[up["scope"]]):
        raise ValueError(f"check.{check}.escalate: the level is not above the scope's own")
    if not (whole(runs) and count is None and pct is None or runs is None and whole(count) and share):
        raise ValueError(f"check.{check}.escalate: min_count with min_pct, or min_runs alone")
    return {"escalate_to": up["level"]} | ({"min_runs": runs} if runs is not None else {"min_count": count, "min_pct": float(pct)})


@dataclass(frozen=True)
class Policy:
    #: (check, scope) to rule; scope is catalog, reference or new_item
    rules: dict[tuple[str, str], Rule]
    fingerprint: str = field(default="")

    @staticmethod
    def parse(text: str) -> Policy:
        """From TOML: [check.<name>] with ``scopes`` (scope to level) and, if it may escalate, ``escalate`` (scope, level and
        either min_count with min_pct or min_runs)."""
        raw = tomllib.loads(text)
        rules = {}
        for check, spec in raw.get("check", {}).items():
            scopes, up = spec.get("scopes"), spec.get("escalate")
            if set(spec) - {"scopes", "escalate"} or not scopes or set(scopes.values()) - set(LEVELS[:3]) or set(scopes) & {"required", "optional"}:
                raise ValueError(f"check.{check}: not a rule")
            more = {} if up is None else _escalation(check, up, scopes)
            for scope, level in scopes.items():
                rules[check, scope] = Rule(level, **(more if up and up["scope"] == scope else {}))
        return Policy(rules, hashlib.sha256(json.dumps(raw, sort_keys=True, separators=(",", ":")).encode()).hexdigest())

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row for each rule; a policy is a file of a few lines."""
        rows = [(c, s, LEVELS.index(r.level), LEVELS.index(r.escalate_to) if r.escalate_to else None, r.min_count, float(r.min_pct), r.min_runs) for (c, s), r in sorted(self.rules.items())]
        return spark.createDataFrame(rows, "check string, scope string, base int, raised int, min_count long, min_pct double, min_runs long")


#: Columns of a finding, with their types; level is the place in LEVELS.
FINDING = {
    "check": "string", "scope": "string", "level": "int", "count": "long", "affected": "long", "population": "long", "pct": "double",
    "escalated": "boolean", "first_key": "string", "runs": "long", "sources": "string", "message": "string",
}


def findings(rows: DataFrame, policy: DataFrame, population: DataFrame) -> DataFrame:
    """The FINDING columns for each check's rows in each scope.

    rows: check and the gate columns. A row is in scope new_item if it is new and its check has a rule for that, else in its
    entry_kind's, else in catalog. Of rows with one key the greatest affected counts, then the greatest runs; less than
    nothing counts as nothing. A scope's share is taken of the last release's population; without one nothing escalates by
    share, and it is the exact share that is compared. With min_runs only the rows that have lasted so long escalate, and
    are a finding of their own. A check or scope without a rule is an info finding that says so; a ruled one that affects
    nothing is none.
    """
    rules = F.broadcast(policy)
    new_rules = policy.where("scope = 'new_item'").select(F.col("check").alias("_check"), F.lit(True).alias("_new"))
    scoped = rows.join(F.broadcast(new_rules), F.col("check") == F.col("_check"), "left").withColumn(
        "scope", F.when(F.col("is_new_item") & F.coalesce("_new", F.lit(False)), "new_item").otherwise(F.coalesce("entry_kind", F.lit("catalog")))
    )
    affected = F.greatest(F.coalesce("affected", F.lit(0)), F.lit(0)).cast("long")
    rank = F.struct(affected.alias("affected"), F.coalesce("runs", F.lit(-1)).cast("long").alias("runs"))
    once = scoped.groupBy("check", "scope", "entity_type", "entity_key").agg(F.max(rank).alias("m")).select(
        "check", "scope", "entity_key", "m.affected", F.nullif(F.col("m.runs"), F.lit(-1)).alias("runs")
    )
    judged = once.join(rules, ["check", "scope"], "left").withColumn("long", F.coalesce(F.col("min_runs").isNotNull() & (F.coalesce("runs", F.lit(0)) >= F.col("min_runs")), F.lit(False)))
    grouped = judged.groupBy("check", "scope", "base", "raised", "min_count", "min_pct", "min_runs", "long").agg(
        F.count("*").alias("count"), F.sum("affected").alias("affected"), F.min("entity_key").alias("first_key"), F.max("runs").alias("runs")
    )
    sized = grouped.join(F.broadcast(population.select("scope", F.col("value").cast("long").alias("population"))), "scope", "left")
    share = F.when(F.col("population") > 0, 100.0 * F.col("affected") / F.col("population"))
    by_share = F.col("min_runs").isNull() & (F.col("affected") >= F.col("min_count")) & F.coalesce(share >= F.col("min_pct"), F.lit(False))
    up = F.col("raised").isNotNull() & (F.col("long") | by_share)
    checks = F.broadcast(policy.select(F.col("check").alias("_known")).distinct())
    named = sized.withColumn("share", share).withColumn("escalated", up).join(checks, F.col("check") == F.col("_known"), "left")
    where = F.concat("check", F.lit(": "), F.col("affected").cast("string"), F.lit(" in "), "scope")
    message = (
        F.when(F.col("_known").isNull(), F.concat(F.lit("no rule for the check "), "check"))
        .when(F.col("base").isNull(), F.concat("check", F.lit(": scope "), "scope", F.lit(" not in policy")))
        .when(F.col("min_runs").isNotNull(), F.concat(where, F.when(F.col("runs") > 0, F.concat(F.lit(", up to "), F.col("runs").cast("string"), F.lit(" runs"))).otherwise("")))
        .otherwise(F.concat(where, F.when(F.col("share").isNotNull(), F.concat(F.lit(" of "), F.col("population").cast("string"))).otherwise("")))
    )
    return named.where(F.col("base").isNull() | F.col("min_runs").isNotNull() | (F.col("affected") > 0)).select(
        "check", "scope", F.when(F.col("escalated"), F.col("raised")).otherwise(F.coalesce("base", F.lit(0))).alias("level"),
        "count", "affected", "population", F.round("share", 6).alias("pct"), "escalated", "first_key", "runs", F.col("check").alias("sources"), message.alias("message"),
    )


def _as_findings(df: DataFrame, **given: Column) -> DataFrame:
    default = {"scope": F.lit("all"), "escalated": F.lit(False), "sources": F.lit("")}
    return df.select(*[given.get(c, default.get(c, F.lit(None))).cast(kind).alias(c) for c, kind in FINDING.items()])


def run_findings(results: DataFrame) -> DataFrame:
    """Findings of expectations (name, grp, status, failures, message) beside the policy's rows: one that broke, failed or
    was left out is an error; an info expectation with rows is an info finding; other warnings are unclassified."""
    n = F.coalesce(F.col("failures"), F.lit(0)).cast("long")
    broken = F.col("status").isin(*BROKEN)
    told = results.where(broken | ((F.col("status") == "warn") & (F.col("grp") != "policy")))
    text = F.when(broken, F.concat_ws(" ", "name", "status", "message")).when(F.col("grp") == "info", F.coalesce("message", F.concat("name", F.lit(": "), n.cast("string"), F.lit(" rows")))).otherwise(F.concat(F.lit("unclassified warning "), "name"))
    count = F.when(broken, F.greatest(n, F.lit(1))).otherwise(n)
    return _as_findings(told, check=F.when(broken, "run").otherwise(F.col("name")), level=F.when(broken, 3).otherwise(0), count=count, affected=count, sources=F.col("name"), message=text)


def canary_finding(policy: DataFrame, failed: bool | None) -> DataFrame:
    """A failed canary is a finding of its rule's level (blocker without one), one that did not run is info, else none."""
    level = policy.where("check = 'canary' AND scope = 'catalog'").agg(F.coalesce(F.max("base"), F.lit(2)).alias("level"))
    count, text = F.lit(1 if failed else 0), "canary failed" if failed else "canary not run"
    one = level if failed is not False else level.limit(0)
    return _as_findings(one, check=F.lit("canary"), scope=F.lit("catalog"), level=F.col("level") if failed else F.lit(0), count=count, affected=count, message=F.lit(text))


def with_streaks(found: DataFrame, past: DataFrame, run_id: str, started_at: str) -> DataFrame:
    """Findings with consecutive_runs: 1 and the earlier runs without a gap before this one in which check and scope had a
    warning or worse. past: run_id, started_at, check, scope, level. Runs are few: one row of the history for each."""
    earlier = past.where((F.col("run_id") != run_id) & (F.col("started_at") < started_at))
    order = F.concat_ws(" ", "started_at", "run_id")
    hits = earlier.where("level >= 1").select(F.struct("check", "scope").alias("_key"), order.alias("_run"))
    lasted = streaks(earlier.select(order.alias("_run")), hits, "_key", "_run").select("_key.*", F.col("runs").alias("_runs"))
    return found.join(lasted, ["check", "scope"], "left").withColumn("consecutive_runs", F.lit(1) + F.coalesce("_runs", F.lit(0))).drop("_runs")


def ordered(found: DataFrame) -> DataFrame:
    """The worst first, then by check, scope, escalated, sources and message."""
    return found.orderBy(F.desc("level"), "check", "scope", "escalated", "sources", "message")


def merged(found: DataFrame) -> DataFrame:
    """One row for each check and scope: the highest level with its share, counts added up, whether any escalated."""
    top = F.max_by("pct", F.struct("level", F.coalesce("pct", F.lit(-1.0)))).alias("pct")
    return found.groupBy("check", "scope").agg(F.max("level").alias("level"), F.sum("affected").alias("affected"), F.max("population").alias("population"), top, F.bool_or("escalated").alias("escalated"), F.max("consecutive_runs").alias("consecutive_runs"))


def record(found: DataFrame, folder: str, run_id: str) -> None:
    """Put the run's merged findings and then its decision into the tables in ``folder``; a run that has been decided is refused.

    Findings lie in a partition for each run, which a run that was stopped before its decision writes over when it is
    recorded again. A run is recorded once it is decided: :func:`recorded` leaves out findings of others.
    """
    spark = found.sparkSession
    decision = decide(found).withColumn("run_id", F.lit(run_id))
    path = f"{folder}/gate_decision"
    if exists(spark, path) and not spark.read.schema(decision.schema).parquet(path).where(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} has been decided before")
    own = merged(found).withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    own.partitionBy("run_id").parquet(f"{folder}/gate_finding")
    decision.write.mode("append").parquet(path)


#: Columns of a recorded finding and of a decision.
RECORDED = "check string, scope string, level int, affected long, population long, pct double, escalated boolean, consecutive_runs int, run_id string"
DECISION = "decision string, publishable boolean, findings long, run_id string"


def recorded(spark: SparkSession, folder: str) -> DataFrame:
    """The findings of all decided runs; a folder without any gives none."""
    if not exists(spark, f"{folder}/gate_decision"):
        return spark.createDataFrame([], RECORDED)
    decided = spark.read.schema(DECISION).parquet(f"{folder}/gate_decision").select("run_id")
    return spark.read.schema(RECORDED).parquet(f"{folder}/gate_finding").join(decided, "run_id", "left_semi").select(*spark.createDataFrame([], RECORDED).columns)


def samples(rows: DataFrame, n: int = SAMPLE) -> DataFrame:
    """For each check the n least keys, found by partial aggregates that never hold more than n."""
    nth = F.row_number().over(Window.partitionBy("check").orderBy("entity_key"))
    return rows.select("check", "entity_key").distinct().withColumn("nth", nth).where(F.col("nth") <= n).groupBy("check").agg(F.sort_array(F.collect_list("entity_key")).alias("keys"))


def decide(found: DataFrame) -> DataFrame:
    """One row: the decision pass, warning, blocker or error, whether it may be published, and how many findings there are."""
    top = F.coalesce(F.max("level"), F.lit(0))
    return found.agg(top.alias("top"), F.count("*").alias("findings")).select(
        F.when(F.col("top") == 3, "error").when(F.col("top") == 2, "blocker").when(F.col("top") == 1, "warning").otherwise("pass").alias("decision"), (F.col("top") < 2).alias("publishable"), "findings"
    )
