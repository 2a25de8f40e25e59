"""Every query with an oracle gives the oracle's rows on the smallest supplied tables."""

import os

import duckdb
import pytest

from wayloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")


def _cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 6)
    return str(v) if hasattr(v, "isoformat") else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_cell(r[k]) for k in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_matches_oracle(spark, db, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = db.execute(catalogue.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_oracle_has_rows(spark, name):
    rows = catalogue.QUERIES[name](spark, SF).collect()
    assert rows
    for r in rows:
        if "same" in r and "tiles" in r:
            assert r.same == r.tiles
        elif "same" in r:
            assert r.same
        if "bad" in r:
            assert r.bad == 0
