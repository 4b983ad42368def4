"""Every query this package offers, by name, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: The query that ``entry`` runs.
FLAGSHIP = "agg_01_count_grouped"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under a name, with its DuckDB SQL if there is any."""

    def put(function):
        if name in _QUERIES:
            raise ValueError(f"two queries are called {name}")
        _QUERIES[name] = function
        if sql is not None:
            _ORACLES[name] = sql
        return function

    return put


def _load() -> None:
    from millrace.plans import checks, contracts, digests, history, lineage, loading, packages, pages, records, relational, release, releases, sourcing, versions, warehouse  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _ORACLES
