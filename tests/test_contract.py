"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from starmart.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tools.compare import TABLES, frame_hash, type_differences

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    frame, relation = E.queries()[name](spark, SF_SMALL), duck.sql(E.oracle_sql()[name])
    assert type_differences(frame, relation) == {}
    got, want = frame.toPandas(), relation.df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "o_orderdate", "customer_nation", "supplier_nation", "l_extendedprice"]
    assert df.count() >= 0
