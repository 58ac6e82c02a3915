"""Key checks (DQ-1..4, AGG-2, AGG-3) and the regressions B4..B6, B11."""

from __future__ import annotations

from starmart.operators.quality import (
    check_report,
    duplicate_offenders,
    key_profile,
    null_key_count,
    null_key_sample,
    read_back,
    write_parquet_observed,
)


def test_b5_separator_collision_is_not_a_duplicate(spark):
    df = spark.createDataFrame([("a_b", "c"), ("a", "b_c")], "x string, y string")
    p = key_profile(df, ["x", "y"]).first()
    assert (p.rows, p.distinct_keys, p.duplicate_keys) == (2, 2, 0)


def test_b4_b6_every_key_column_checked_and_nulls_reported_apart(spark):
    df = spark.createDataFrame(
        [(2016, 4, "NY"), (2016, None, "NY"), (None, 4, "CA"), (2016, 4, "NY"), (2016, 5, None)],
        "year int, month int, state string",
    )
    keys = ["year", "month", "state"]
    p = key_profile(df, keys).first()
    assert p.null_key_rows == 3
    assert (p.distinct_keys, p.duplicate_keys, p.duplicate_rows) == (1, 1, 1)
    assert null_key_count(df, keys).first().null_key_rows == 3
    assert len(null_key_sample(df, keys)) == 1
    assert [tuple(r) for r in duplicate_offenders(df, keys).collect()] == [(2016, 4, "NY", 2)]


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "k bigint")
    p = key_profile(df, ["k"]).first()
    assert tuple(p) == (0, 0, 0, 0, 0)


def test_report_rows(spark):
    good = spark.createDataFrame([(1,), (2,)], "k bigint")
    bad = spark.createDataFrame([(1,), (1,), (None,)], "k bigint")
    rep = {(r.table_name, r.rule): (r.failures, r.passed) for r in check_report({"good": (good, ["k"]), "bad": (bad, ["k"])}).collect()}
    assert rep == {
        ("good", "null_keys"): (0, True),
        ("good", "duplicate_keys"): (0, True),
        ("bad", "null_keys"): (1, False),
        ("bad", "duplicate_keys"): (1, False),
    }


def test_write_is_observed_and_read_back(spark, workdir):
    df = spark.range(1000).selectExpr("id", "id % 7 AS g")
    m = write_parquet_observed(df, f"{workdir}/t", partition_by=["g"])
    assert m["rows"] == 1000
    check = read_back(spark, "t", f"{workdir}/t", m["rows"])
    assert check.passed and check.read_rows == 1000
