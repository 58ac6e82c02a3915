"""Merges (MRG-1..3, JOI-3..5, SET-3, SET-5) and their properties."""

from __future__ import annotations

import pytest

from starmart.operators.merge import insert_only, upsert

SCHEMA = "k bigint, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# Each merge runs on both plans: broadcast of the batch keys and sort-merge.
PLANS = [pytest.param(4_000_000, id="broadcast"), pytest.param(0, id="shuffle")]


@pytest.mark.parametrize("limit", PLANS)
def test_insert_only_keeps_existing_rows(spark, limit):
    target = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    staging = spark.createDataFrame([(2, "CHANGED"), (3, "c"), (3, "c"), (4, "d")], SCHEMA)
    m = insert_only(target, staging, ["k"], max_broadcast_rows=limit)
    assert rows(m.result) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert rows(m.stats("t").drop("table_name")) == [(2, 2, 0, 4)]


@pytest.mark.parametrize("limit", PLANS)
def test_insert_only_twice_changes_nothing(spark, limit):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    staging = spark.createDataFrame([(2, "b"), (1, "x")], SCHEMA)
    once = insert_only(target, staging, ["k"], limit).result
    twice = insert_only(once, staging, ["k"], limit).result
    assert rows(once) == rows(twice) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("limit", PLANS)
def test_b10_null_in_target_does_not_block_inserts(spark, limit):
    target = spark.createDataFrame([(None, "n"), (1, "a")], SCHEMA)
    staging = spark.createDataFrame([(2, "b")], SCHEMA)
    assert rows(insert_only(target, staging, ["k"], limit).inserted) == [(2, "b")]


@pytest.mark.parametrize("limit", PLANS)
def test_b8_two_rows_one_key_both_inserted(spark, limit):
    target = spark.createDataFrame([], SCHEMA)
    staging = spark.createDataFrame([(7, "x"), (7, "y")], SCHEMA)
    assert rows(insert_only(target, staging, ["k"], limit).result) == [(7, "x"), (7, "y")]


@pytest.mark.parametrize("limit", PLANS)
def test_upsert_replaces_matched_keeps_unmatched(spark, limit):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], SCHEMA)
    staging = spark.createDataFrame([(2, "B"), (2, "B"), (3, "c"), (None, "m")], SCHEMA)
    m = upsert(target, staging, ["k"], limit)
    got = rows(m.result.fillna(-1, ["k"]))
    assert got == [(-1, "m"), (-1, "n"), (1, "a"), (2, "B"), (3, "c")]
    assert rows(m.stats("t").drop("table_name")) == [(3, 3, 1, 5)]


@pytest.mark.parametrize("limit", PLANS)
def test_upsert_composite_key(spark, limit):
    schema = "year int, month int, state string, avg_rate double"
    target = spark.createDataFrame([(2016, 4, "NY", 4.0), (2016, 4, "CA", 6.0), (2016, 5, "NY", 3.0)], schema)
    staging = spark.createDataFrame([(2016, 4, "NY", 4.5), (2016, 6, "NY", 2.0)], schema)
    got = rows(upsert(target, staging, ["year", "month", "state"], limit).result)
    assert got == [(2016, 4, "CA", 6.0), (2016, 4, "NY", 4.5), (2016, 5, "NY", 3.0), (2016, 6, "NY", 2.0)]


@pytest.mark.parametrize("limit", PLANS)
def test_upsert_idempotent_and_conserves_rows(spark, limit):
    target = spark.createDataFrame([(i, f"v{i}") for i in range(20)], SCHEMA)
    staging = spark.createDataFrame([(i, f"w{i}") for i in range(10, 30)], SCHEMA)
    once = upsert(target, staging, ["k"], limit)
    r1 = rows(once.result)
    # |result| = |target| - |matched| + |distinct staging|
    assert len(r1) == 20 - 10 + 20
    assert rows(upsert(once.result, staging, ["k"], limit).result) == r1


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a")], SCHEMA)
    assert rows(upsert(empty, some, ["k"]).result) == [(1, "a")]
    assert rows(upsert(some, empty, ["k"]).result) == [(1, "a")]
    assert rows(insert_only(empty, some, ["k"]).result) == [(1, "a")]
    assert rows(insert_only(some, empty, ["k"]).result) == [(1, "a")]
