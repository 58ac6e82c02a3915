"""Scalar conversions (PRJ-2..10) with the edge rows of FIXTURES.md."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starmart.functions import (
    cast_columns,
    compact_date,
    epoch_day_to_date,
    month_name_to_number,
    rename_columns,
    strip,
)


def test_epoch_day_to_date_truncates_and_keeps_nulls(spark):
    df = spark.createDataFrame([(20545.0,), (20545.9,), (0.0,), (None,), (-1.5,)], "d double")
    out = [r[0] for r in df.select(epoch_day_to_date("d")).collect()]
    assert out == [dt.date(2016, 4, 1), dt.date(2016, 4, 1), dt.date(1960, 1, 1), None, dt.date(1959, 12, 31)]


def test_epoch_day_out_of_int_range_is_null(spark):
    df = spark.createDataFrame([(1e12,)], "d double")
    assert df.select(epoch_day_to_date("d")).first()[0] is None


def test_compact_dates_both_orders(spark):
    df = spark.createDataFrame(
        [("20160401", "04302016"), ("2016040", "D/S"), ("", ""), (None, None), ("20161301", "13012016")],
        "ymd string, mdy string",
    )
    rows = df.select(compact_date("ymd", "yyyyMMdd"), compact_date("mdy", "MMddyyyy")).collect()
    assert rows[0] == (dt.date(2016, 4, 1), dt.date(2016, 4, 30))
    assert all(r[0] is None and r[1] is None for r in rows[1:])


def test_b1_stay_limit_is_parsed_from_its_own_text(spark):
    """B1: the stay limit differs from the file date and must not copy it."""
    from starmart.plans.tables import build_fact
    from tests.fixtures import raw_fact_rows
    from starmart.schemas import RAW_FACT_SCHEMA

    raw = spark.createDataFrame(raw_fact_rows(), RAW_FACT_SCHEMA)
    fact = build_fact(raw).where(F.col("immigration_id") == 1).first()
    assert fact.date_file == dt.date(2016, 4, 1)
    assert fact.permitted_to_stay_until == dt.date(2016, 10, 1)


def test_b2_month_names_full_any_case(spark):
    names = ["January", "february", "MARCH", "April", "May", "June", "July", "August",
             "September", "October", "November", "December", "Janury", None, ""]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    out = [r[0] for r in df.select(month_name_to_number("m")).collect()]
    assert out == list(range(1, 13)) + [None, None, None]


def test_b3_casts_never_raise_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame(
        [(3.9, -3.9, 5680949530.0, "12"), (None, 1e20, 1.0, "x"), (0.0, 0.0, 0.0, " 7 ")],
        "a double, b double, c double, t string",
    )
    out = cast_columns(df, {"a": "int", "b": "int", "c": "bigint", "t": "int"}).collect()
    assert tuple(out[0]) == (3, -3, 5680949530, 12)
    assert tuple(out[1]) == (None, None, 1, None)
    assert tuple(out[2]) == (0, 0, 0, 7)


def test_cast_columns_keeps_order_and_untouched_columns(spark):
    df = spark.createDataFrame([(1.5, "a", 2.5)], "x double, y string, z double")
    out = cast_columns(df, {"z": "int"})
    assert out.columns == ["x", "y", "z"]
    assert dict(out.dtypes) == {"x": "double", "y": "string", "z": "int"}


def test_rename_identity_and_absent_names(spark):
    df = spark.createDataFrame([(1.0, "M")], "cicid double, gender string")
    out = rename_columns(df, {"cicid": "immigration_id", "gender": "gender", "nope": "x"})
    assert out.columns == ["immigration_id", "gender"]


def test_strip_removes_tabs_and_carriage_returns(spark):
    df = spark.createDataFrame([("\t  ALBANIA  \r",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(strip("s")).collect()] == ["ALBANIA", "x", None]


def test_text_to_int_shape_check_matches_cast(spark):
    values = ["12", " 7 ", "+3", "-4", "1.5", "n/a", "", None, "99999999999", "\t8\t"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in cast_columns(df, {"t": "int"}).collect()]
    want = [r[0] for r in df.selectExpr("try_cast(t as int)").collect()]
    assert got == want == [12, 7, 3, -4, None, None, None, None, None, 8]


def test_integral_narrowing_matches_try_cast(spark):
    df = spark.createDataFrame([(5000000000,), (-5,), (2147483647,), (None,)], "b bigint")
    got = [r[0] for r in cast_columns(df, {"b": "int"}).collect()]
    assert got == [None, -5, 2147483647, None]
