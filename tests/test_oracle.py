"""Every registered query of the time-series part against its SQL on the smallest tables."""

import duckdb
import pytest

from hourloom import queries as core
from hourloom import report_queries, run_queries  # noqa: F401

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "orders", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_query_matches_sql(spark, duck, name):
    df = core.QUERIES[name](spark, D)
    rel = duck.sql(core.SQL[name])
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    at = [rel.columns.index(c) for c in names]
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
