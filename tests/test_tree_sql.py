"""The SQL of hsh_05_tree has as many levels as the tree."""

from __future__ import annotations

import duckdb

from __spark_entry__ import oracle_sql, queries


def test_levels_grow_with_the_keys(spark, tmp_path):
    # 16 ** 3 + 1 leaves call for levels 0 to 3, and 16 ** 4 + 1 for level 4
    for leaves, top in ((16, 0), (17, 1), (16**4, 3), (16**4 + 1, 4)):
        at = tmp_path / str(leaves)
        at.mkdir()
        db = duckdb.connect()
        db.execute(f"CREATE TABLE lineitem AS SELECT k * 64 AS l_orderkey, 1 AS l_linenumber, 1 AS l_partkey, 1.0 AS l_quantity FROM range({leaves}) r(k)")
        db.execute(f"COPY lineitem TO '{at}/lineitem.parquet' (FORMAT parquet)")
        want = sorted(db.execute(oracle_sql()["hsh_05_tree"]).fetchall())
        assert max(r[0] for r in want) == top
        assert sorted(map(tuple, queries()["hsh_05_tree"](spark, str(at)).collect())) == want
