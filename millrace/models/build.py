"""A build: raw frames, the last release's history and the run's constants in; every model once, when it is asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODELS: dict[str, Callable[[Build], DataFrame]] = {}
#: Models that several others read: they are written once and read again.
STORED: set[str] = set()


def model(stored: bool = False):
    """Register a function of a build as the model of its name."""

    def put(function):
        MODELS[function.__name__] = function
        if stored:
            STORED.add(function.__name__)
        return function

    return put


@dataclass(frozen=True)
class Run:
    """What is the same for every row of a build."""

    revision: int
    run_id: str
    #: ISO-8601, UTC
    started_at: str
    bootstrap: bool = False
    code_commit: str = ""
    parser_version: int = 1
    transform_version: int = 1
    last_complete_run: int = 0
    scope_fingerprint: str = ""
    catalog_version: str = ""
    prev_run_id: str | None = None
    prev_parser_version: int | None = None
    prev_transform_version: int | None = None
    new_item_days: int = 7
    alias_days: int = 7
    alias_score: float = 0.9


#: Frames of a build are as large as its tables, and a broadcast one lies whole in the driver, several for each job that runs:
#: files of a few MB hold a hundred. So they meet others by a shuffle, whatever their size seems to be.
MEET = "merge"
#: Jobs of a build that run at a time.
AT_ONCE = 6


def together(jobs: Iterable[tuple[str, Callable[[], DataFrame]]]) -> list[tuple[str, DataFrame]]:
    """What the jobs give, AT_ONCE of them running at a time; the first that fails stops the caller."""
    names, calls = zip(*jobs, strict=True)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(zip(names, pool.map(lambda call: call(), calls), strict=True))


class Locks:
    """A lock for each name, so that of two threads that ask for a model one makes it and the other waits. Models depend on
    each other in one direction only, and so does the waiting."""

    def __init__(self):
        self._own, self._named = RLock(), {}

    def __getitem__(self, name: str) -> RLock:
        with self._own:
            return self._named.setdefault(name, RLock())


@dataclass
class Build:
    spark: SparkSession
    run: Run
    #: stg_* and the alias lists; a frame, or what makes it when it is first asked for
    raw: dict[str, DataFrame | Callable[[], DataFrame]]
    #: tables of the last release's history; a missing one is empty
    previous: Mapping[str, DataFrame]
    #: where stored models go; without it they are recomputed
    folder: str | None = None
    made: dict[str, DataFrame] = field(default_factory=dict)
    locks: Locks = field(default_factory=lambda: Locks())

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.made:
            return self.made[name]
        with self.locks[name]:
            if name not in self.made:
                self.made[name] = self._make(name).hint(MEET)
            return self.made[name]

    def _make(self, name: str) -> DataFrame:
        if name not in MODELS:
            made = self.raw[name] if name in self.raw else self.spark.createDataFrame([], RAW[name])
            return made() if callable(made) else made
        frame = MODELS[name](self)
        if self.folder and name in STORED:
            frame.write.mode("overwrite").parquet(f"{self.folder}/{name}")
            frame = self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{name}")
        return frame

    def frames(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Several models by name. Most are small jobs that leave cores idle, so some of them run at a time."""
        return dict(together((name, lambda name=name: self[name]) for name in names))

    def prev(self, name: str) -> DataFrame:
        return (self.previous[name] if name in self.previous else self.spark.createDataFrame([], HISTORY[name])).hint(MEET)

    def known_equipment(self) -> DataFrame:
        """uid, state, retired_revision of the equipment that the last release knows. A history that is just being made tells
        it without the hashes of all records, which its current state needs."""
        told = getattr(self.previous, "equipment", None)
        if told is not None:
            return told().hint(MEET)
        return self.prev("entity_current").where("entity_type = 'equipment' AND last_operation <> 'DELETE'").select(F.col("entity_key").alias("uid"), "state", "retired_revision")

    @property
    def now(self) -> Column:
        return F.lit(self.run.started_at)

    @property
    def revision(self) -> Column:
        return F.lit(self.run.revision).cast("long")


#: Columns of the raw tables and of the history, with their types.
RAW = {
    "stg_equipment": "source_uid string, source_hash string, model_class string, name string, rarity string, gear_type string, cost long, element_id string, max_level long",
    "stg_weapon": "source_uid string, infusion_count long",
    "stg_defensive_gear": "source_uid string, infusion_count long",
    "stg_monster": "source_uid string, restrictions string",
    "stg_stat": "source_uid string, label string, tier string, value long, label_ordinal long, tier_ordinal long",
    "stg_proc": "source_uid string, name string, effect_hash string, activation_rate string, raw_effect_text string",
    "stg_proc_condition": "source_uid string, ordinal long, condition string",
    "stg_proc_scaling": "source_uid string, ordinal long, description string",
    "stg_weapon_ability": "source_uid string, uid string, name string",
    "stg_monster_skill": "source_uid string, ordinal long, name string",
    "stg_passive_skill": "source_uid string, name string, effect_hash string",
    "stg_potential_level": "source_uid string, level long, target string, description string",
    "stg_skill_effect": "source_uid string, owner_kind string, owner_ordinal long, ordinal long, target string, description string",
    "stg_evolution": "source_uid string, kind string, before_uid string, before_name string",
    "stg_evolution_material": "source_uid string, kind string, ordinal long, material_kind string, ref_uid string, ref_name string, quantity long",
    "stg_element": "element_id string",
    "stg_element_relation": "element_id string, kind string, ordinal long, related_id string",
    "stg_parse_error": "source_id string, source_hash string, parser_version long, error string, run_id string",
    "stg_page": "url string, kind string, item_id string, html_sha256 string, etag string, fetched_at string, run_id long",
    "stg_frontier": "item_id string, source string, entry_kind string, keep_reason string, depth long, parent_id string, state string, last_error string, decided_run_id long, discovered_at string",
    "stg_listing": "item_id string, name string, grp string, rarity string, cost long",
    "stg_asset": "url string, item_id string, kind string, sha256 string, fetched_at string, body_bytes long",
    "stg_meta": "key string, value string",
    "stg_crawl_run": "run_id long, trigger string, status string, started_at string, ended_at string, pages_discovered long, pages_fetched long, pages_changed long, pages_failed long, pages_not_modified long, icons_fetched long, icons_changed long, icons_failed long, new_release_skipped long",
    "stg_unlisted_release": "item_id string, name string, runs long",
    "confirmed_aliases": "old_uid string, new_uid string, note string",
    "rejected_aliases": "old_uid string, new_uid string, note string",
    "vocabulary": "domain string, value string",
}
HISTORY = {
    "entity_current": "entity_type string, entity_key string, row_hash string, content_hash string, last_revision long, last_operation string, state string, retired_revision long, content_changed_at string",
    "dataset_changes": "revision long, entity_type string, entity_key string, operation string, row_hash string, changed_at string",
    "row_version": "entity_type string, entity_key string, row_hash string, revision long",
    "uid_retired": "uid string, since_revision long, reason string",
    "uid_alias": "old_uid string, new_uid string, since_revision long, confirmed_commit string",
    "alias_candidate": "old_uid string, new_uid string, first_seen_revision long, score double, evidence string",
    "alias_rejected": "old_uid string, new_uid string, revision long, rejected_commit string",
    "equipment_seen": "uid string, first_seen string, first_revision long",
    "population": "run_id string, revision long, scope string, value long, observed_at string",
    "transform_run": "revision long, started_at string",
    "obs_data_quality": "run_id string, metric string, scope string, value double, prev_value double, delta_pct double, observed_at string",
    "obs_unlisted_release": "run_id string, item_id string, name string, runs long, observed_at string",
}
