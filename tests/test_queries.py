"""Every query with SQL gives what DuckDB gives on the same tables; the others give rows."""

import duckdb
import pytest

from millrace.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def shown(value):
    return repr(round(value, 6)) if isinstance(value, float) else repr(value)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    got = registry.queries()[name](spark, SF)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got.count() >= 0
        return
    want = con.execute(sql)
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = got.select(*[f"`{c}`" for c in columns]).collect()
    assert sorted(tuple(map(shown, r)) for r in rows) == sorted(tuple(map(shown, r)) for r in want.fetchall())


def test_the_whole_log_is_netted(spark):
    got = registry.queries()["cdc_09_net_operations_log"](spark, SF)
    log = spark.read.parquet(f"{SF}/events.parquet").where("event_type <> 'click'")
    assert got.agg({"revision": "max"}).first()[0] > 0.9 * log.agg({"event_id": "max"}).first()[0]


@pytest.mark.parametrize("name", ["graph_02_cycles_in_blocks", "graph_04_expand_many"])
def test_graphs_grow_with_the_tables(spark, name):
    small, large = (registry.queries()[name](spark, d).count() for d in (SF, SF.replace("sf0.001", "sf0.01")))
    assert large > 5 * small > 0
