"""Round trip on the driver tables: every registered query against its DuckDB
twin at sf0.001 (the driver runs the same comparison at sf0.01)."""

import hashlib
import json
import os

import duckdb
import pytest

import __spark_entry__ as entry
from docshred.plans import oracle, queries

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted(json.dumps([r[i] for i in order], default=str) for r in rows))
                        .encode()).hexdigest()


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(oracle.oracle_sql()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _digest(got, df.columns) == _digest(want, cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["patient_id", "PAA_version", "method", "code", "description", "priority", "type"]
    assert df.count() > 0
