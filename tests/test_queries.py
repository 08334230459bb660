"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, cells

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    if name in ORACLES:
        want = db.execute(ORACLES[name]).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert cells(got) == cells(want)


def test_entry(spark):
    assert entry.entry(spark).count() == 200


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())
