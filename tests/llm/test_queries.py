"""The registered queries of the training-data operators against their DuckDB SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from starmart.llm import registry
from tests.conftest import SF_SMALL
from tools.compare import TABLES, frame_hash, type_differences


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_numbers_of_the_registered_queries():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.ORACLE_SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    frame, relation = E.queries()[name](spark, SF_SMALL), duck.sql(registry.ORACLE_SQL[name])
    assert type_differences(frame, relation) == {}
    got, want = frame.toPandas(), relation.df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)


def test_sql_and_queries_agree_on_repeated_and_null_ids(spark, tmp_path):
    """Rows equal in everything, ids held by several texts, null ids, null and empty texts."""
    con = duckdb.connect()
    passage = " ".join(f"w{k}" for k in range(40))
    lines = "\n".join(f"line {k}" for k in range(6))
    texts = [passage, "x " + passage, lines, "own\n" + lines, lines, "password = abcdef\n" * 3, None, "", "one two three", passage + "\n" + lines]
    rows = [(i, t, lang, source) for i in (None, 1, 2, 7) for t in texts for lang, source in (("en", "a"), (None, None))]
    rows += rows[:12] + [(None, passage, "en", "a")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    urls = [None, "", "http://a.net/x", "http://a.net/x", "nothing", "http://www.example.net/en/" + "p/" * 50, "http://" + "x." * 300 + "org/fr/"] * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").unionByName(spark.createDataFrame([(1, "nothing")] * 40, "page_id long, url string"))
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    for name, sql in registry.ORACLE_SQL.items():
        got, want = E.queries()[name](spark, str(tmp_path)).toPandas(), con.execute(sql).df()
        assert len(got) == len(want) and frame_hash(got) == frame_hash(want), name
