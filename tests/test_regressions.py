
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starmart.plans.marts import arrivals_lookup, top_n
from starmart.plans.stages import build_star_files
from starmart.plans.tables import build_fact, build_origin_from_codes
from starmart.schemas import FACT, RAW_FACT_SCHEMA, REGISTRY
from tests.fixtures import LABEL_TEXT, RATES_CSV, STATES_CSV, raw_fact_rows, write_text


def test_b13_b14_fact_types_and_columns_follow_the_ddl(spark):
    fact = build_fact(spark.createDataFrame(raw_fact_rows(), RAW_FACT_SCHEMA))
    # B14: every DDL column, in order, including airline, admission number and flight number.
    assert fact.columns == FACT.schema.fieldNames()
    types = dict(fact.dtypes)
    # B13: country codes are int in the fact and in the dimension; ids are bigint.
    assert (types["country_of_birth"], types["country_of_residence"]) == ("int", "int")
    assert (types["immigration_id"], types["admission_number"]) == ("bigint", "bigint")
    row = fact.where(F.col("immigration_id") == 1).first()
    assert row.admission_number == 5680949530  # beyond the int range, kept whole
    origin = build_origin_from_codes(spark.createDataFrame([("101", "ALPHALAND")], "code string, label string"))
    assert dict(origin.dtypes)["country_code"] == "int"


def test_b12_read_back_checks_are_labelled_from_the_registry(spark, workdir):
    spark.createDataFrame(raw_fact_rows(), RAW_FACT_SCHEMA).write.parquet(f"{workdir}/raw_fact")
    res = build_star_files(
        spark,
        f"{workdir}/raw_fact",
        write_text(workdir, "labels.SAS", LABEL_TEXT),
        write_text(workdir, "states.csv", STATES_CSV),
        write_text(workdir, "rates.csv", RATES_CSV),
        f"{workdir}/run",
    )
    assert set(res.checks) == set(REGISTRY)
    assert {name: check.table_name for name, check in res.checks.items()} == {n: n for n in REGISTRY}


def test_b15_top_n_is_ordered_and_planned_as_a_top_n(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    got = top_n(df, 10, [F.col("k").desc()])
    assert [r.k for r in got.collect()] == list(range(999, 989, -1))
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()


def test_b19_state_names_come_from_the_states_list_joined_on_code(spark):
    fact = build_fact(spark.createDataFrame(raw_fact_rows(), RAW_FACT_SCHEMA))
    origin = spark.createDataFrame([(101, "ALPHALAND"), (102, "BETA")], "country_code int, country_name string")
    # The code list spells states differently (upper case, misspelt); only the code joins.
    states = spark.createDataFrame(
        [("New York", "NY"), ("California", "CA")], "state_name string, abbreviation string"
    )
    rows = {
        r.immigration_id: (r.country_of_birth, r.state_name, r.arrival_date)
        for r in arrivals_lookup(fact, origin, states).collect()
    }
    assert rows[1] == ("ALPHALAND", "New York", dt.date(2016, 4, 1))
    assert rows[4] == ("ALPHALAND", "California", dt.date(2016, 5, 2))
    assert rows[2] == ("BETA", None, dt.date(2016, 4, 2))  # GU: no state row, name stays null (B20)
    assert rows[3] == (None, None, dt.date(2016, 4, 3))   # birth code 999 is in no list
