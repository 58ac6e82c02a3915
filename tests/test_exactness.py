"""Regressions: no digit, row or check is lost on the inputs the test tables lack."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import Row
from pyspark.sql.types import StringType, StructField, StructType

from starmart.functions.casts import cast_columns
from starmart.plans.publish import TableStore
from starmart.plans.tables import build_fact, build_states, build_unemployment_from_raw
from starmart.schemas import RAW_FACT_COLUMNS, STATES
from starmart.sources.readers import read_csv
from starmart.sources.staging import load_staging

BIG = 9007199254740993


def _rates(spark, *rates):
    rows = [("2016", "April", "Ohio", f"c{k}", r) for k, r in enumerate(rates)]
    raw = spark.createDataFrame(rows, "Year string, Month string, State string, County string, Rate string")
    return build_unemployment_from_raw(raw).first().avg_rate


def test_average_keeps_digits_and_shows_nan_infinity_and_large_values(spark):
    assert _rates(spark, "4.0", "0.0000004") == pytest.approx(2.0000002, abs=1e-12)
    assert math.isnan(_rates(spark, "4.0", "NaN"))
    assert math.isinf(_rates(spark, "4.0", "Infinity"))
    assert _rates(spark, "4.0", "1e40") == pytest.approx(5e39)


@pytest.mark.parametrize("kind,value", [("bigint", BIG), ("string", str(BIG))])
def test_ids_beyond_double_precision_survive(spark, kind, value):
    fields = [f"{c} {kind if c == 'cicid' else 'string'}" for c in RAW_FACT_COLUMNS]
    raw = spark.createDataFrame([tuple(value if c == "cicid" else None for c in RAW_FACT_COLUMNS)], ", ".join(fields))
    assert build_fact(raw).first().immigration_id == BIG


def test_integral_limits_are_legal(spark):
    lo, hi = -(1 << 63), (1 << 63) - 1
    df = spark.createDataFrame([(lo,), (hi,)], "x bigint")
    assert [r.x for r in cast_columns(df, {"x": "bigint"}).collect()] == [lo, hi]
    assert [r.x for r in cast_columns(df, {"x": "int"}).collect()] == [None, None]
    far = spark.createDataFrame([(float(lo),), (float(hi),)], "x double")
    assert [r.x for r in cast_columns(far, {"x": "bigint"}).collect()] == [lo, None]


def test_csv_files_with_other_headers_are_read_by_name(spark, workdir):
    files = {
        "a": "State,Abbreviation\nCalifornia,CA\n",
        "b": "Abbreviation,State\nNY,New York\n\"OH\",\"Ohio\"\n",
        "c": "\n\nabbreviation,STATE,Note\nTX,Texas,\"big, flat\"\n",
        "d 100%+x": "State,Abbreviation\nUtah,UT\n",
        "e": "",
        "f": "State,Abbreviation\n",
    }
    for name, text in files.items():
        with open(f"{workdir}/{name}.csv", "w") as f:
            f.write(text)
    schema = StructType([StructField("State", StringType()), StructField("Abbreviation", StringType())])
    assert read_csv(spark, f"{workdir}/b.csv", schema).first() == Row(State="New York", Abbreviation="NY")
    rows = read_csv(spark, [f"{workdir}/a.csv", f"{workdir}/b.csv"], schema).collect()
    assert {tuple(r) for r in rows} == {("California", "CA"), ("New York", "NY"), ("Ohio", "OH")}
    every = read_csv(spark, workdir, schema)
    assert every.columns == ["State", "Abbreviation", "Note"]
    assert {tuple(r) for r in every.collect()} == {
        ("California", "CA", None), ("New York", "NY", None), ("Ohio", "OH", None), ("Texas", "TX", "big, flat"), ("Utah", "UT", None),
    }
    assert {tuple(r) for r in build_states(spark, workdir).collect()} == {tuple(r)[:2] for r in every.collect()}
    with open(f"{workdir}/g.csv", "w") as f:
        f.write("State,Capital\nIowa,Des Moines\n")
    with pytest.raises(ValueError, match="g.csv.*lacks .*Abbreviation"):
        read_csv(spark, workdir, schema)


def test_readers_get_the_attempt_that_was_checked(spark, workdir):
    store = TableStore(spark, f"{workdir}/store")
    good = spark.createDataFrame([("Ohio", "OH")], STATES.schema)
    bad = spark.createDataFrame([("Ohio", "OH"), ("Ohio", "XX")], STATES.schema)
    first, second = store.stage(STATES, good, 1), store.stage(STATES, bad, 1)
    assert not first.problems and second.problems
    store.publish(first)
    assert [tuple(r) for r in TableStore(spark, f"{workdir}/store").current(STATES).collect()] == [("Ohio", "OH")]
    with pytest.raises(ValueError, match="published already"):
        store.publish(second)


def test_an_empty_batch_has_the_declared_schema(spark, workdir):
    spark.createDataFrame([], STATES.schema).write.partitionBy("abbreviation").parquet(f"{workdir}/none")
    assert load_staging(spark, f"{workdir}/none", STATES).count() == 0
