"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

from conftest import DATA
from quarry.plans import registry
from quarry.plans.inputs import TABLES


def shown(v):
    if v is None or v != v:
        return "None"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.5f}"
    return str(v)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(r[i]) for i in order) for r in found)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    got = rows(df.columns, df.collect())
    if name not in registry.ORACLE_SQL:
        assert got
        return
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == rows(want.columns, want.fetchall())


def test_glare_pairs_take_the_headings_of_all_events(spark):
    others = {r.other_id % 4 for r in registry.QUERIES["glare_pairs_of_all_events"](spark, DATA).collect()}
    assert others == {0, 1, 2, 3}
