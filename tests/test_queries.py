"""Every registered query of the engine against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from quire.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted([tuple(str(v[k]) for k in order) for v in values])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, db, name):
    want = db.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
