"""The registered queries on the smallest supplied tables."""

import hashlib
import os

import duckdb
import pytest

from wayloom.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")


def test_names_cover_the_ten_operators():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]


def test_decontamination_matches_its_oracle(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLES["op2_decontaminate"])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES["op2_decontaminate"](spark, SF).select(*columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_every_row_has_one_result(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op4") else ("documents", "doc_id")
    rows = queries.QUERIES[name](spark, SF).collect()
    ids = sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())
    assert sorted(r[key] for r in rows if "rank" not in r or r.rank == 1) == ids


def test_edited_text_of_fingerprints(spark):
    docs = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in queries.QUERIES["op3_fingerprints"](spark, SF).collect()}
    for k, (i, t) in enumerate(docs):
        third = len(t) // 3
        edited = t[: len(t) - third] + docs[(k + 1) % len(docs)][1][:third]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
