"""End-to-end: stage 1 (raw -> star files) and stage 2 (merge, check, publish)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.plans.marts import arrivals_lookup, arrivals_vs_rate
from starmart.plans.publish import TableStore
from starmart.plans.stages import CheckFailed, build_star_files, load_star_files
from starmart.schemas import FACT, ORIGIN, RAW_FACT_SCHEMA, STATES, UNEMPLOYMENT
from tests.fixtures import (
    LABEL_TEXT,
    RATES_CSV,
    RATES_CSV_CLEAN,
    STATES_CSV,
    raw_fact_edge_rows,
    raw_fact_rows,
    write_text,
)


def _raw_inputs(spark, folder, fact_rows, rates_text=RATES_CSV_CLEAN):
    spark.createDataFrame(fact_rows, RAW_FACT_SCHEMA).write.parquet(f"{folder}/raw_fact")
    labels = write_text(folder, "labels.SAS", LABEL_TEXT)
    states = write_text(folder, "states.csv", STATES_CSV)
    rates = write_text(folder, "rates.csv", rates_text)
    return f"{folder}/raw_fact", labels, states, rates


def test_stage1_builds_and_reads_back(spark, workdir):
    raw, labels, states, rates = _raw_inputs(spark, workdir, raw_fact_rows(), RATES_CSV)
    res = build_star_files(spark, raw, labels, states, rates, f"{workdir}/run1")
    assert all(c.passed for c in res.checks.values())
    assert res.checks[FACT.name].written_rows == 4
    assert res.checks[STATES.name].written_rows == 3          # duplicate state row removed
    assert res.rejects["rejected_dtaddto"] == 2               # 'D/S' and '' (null is not a reject)
    unemp = {(r.year, r.month, r.state): r.avg_rate for r in spark.read.parquet(res.files.path(UNEMPLOYMENT.name)).collect()}
    # duplicate row weighs once, equal rates of two counties both count, bad/null skipped
    assert unemp[(2016, 4, "New York")] == pytest.approx((5.0 + 4.0 + 4.0) / 3)
    assert unemp[(2016, 5, "California")] == 7.5
    assert unemp[(2016, None, "California")] == 7.5
    fact_dirs = spark.read.parquet(res.files.path(FACT.name)).select("arrival_year", "arrival_month").distinct().collect()
    assert {(r.arrival_year, r.arrival_month) for r in fact_dirs} == {(2016, 4), (2016, 5)}


def test_stage2_publishes_and_is_idempotent(spark, workdir):
    raw, labels, states, rates = _raw_inputs(spark, workdir, raw_fact_rows())
    files = build_star_files(spark, raw, labels, states, rates, f"{workdir}/run1").files
    store = TableStore(spark, f"{workdir}/published")
    first = load_star_files(spark, store, files)
    assert first.published
    assert store.current(FACT).count() == 4
    assert store.current(ORIGIN).count() == 6
    # the same batch again: the fact gains nothing, dimensions stay equal
    second = load_star_files(spark, store, files)
    assert second.published
    assert store.published_versions(FACT) == [1, 2]
    assert store.current(FACT).count() == 4
    assert sorted(store.current(STATES).collect()) == sorted(spark.read.parquet(files.path(STATES.name)).collect())

    # analyst lookup over the published tables (B20: GU has no state name)
    fact, origin, states_dim = store.current(FACT), store.current(ORIGIN), store.current(STATES)
    out = {r.immigration_id: r for r in arrivals_lookup(fact, origin, states_dim).collect()}
    assert out[1].country_of_birth == "ALPHALAND" and out[1].state_name == "New York"
    assert out[2].state_name is None and out[2].country_of_residence == "GAMMA ISLANDS"
    assert out[3].country_of_birth is None
    only = arrivals_lookup(fact, origin, states_dim, birth_country="ALPHALAND").collect()
    assert sorted(r.immigration_id for r in only) == [1, 4]
    rate = {(r.year, r.month, r.abbreviation): (r.arrivals, r.avg_rate) for r in arrivals_vs_rate(fact, states_dim, store.current(UNEMPLOYMENT)).collect()}
    assert rate[(2016, 4, "NY")][0] == 1 and rate[(2016, 4, "NY")][1] == pytest.approx(13 / 3)


def test_stage2_new_batch_appends_only_new_ids(spark, workdir):
    raw, labels, states, rates = _raw_inputs(spark, workdir, raw_fact_rows())
    files = build_star_files(spark, raw, labels, states, rates, f"{workdir}/run1").files
    store = TableStore(spark, f"{workdir}/published")
    load_star_files(spark, store, files)
    nxt = [tuple([r[0] + 10] + list(r[1:])) for r in raw_fact_rows()] + [raw_fact_rows()[0]]
    spark.createDataFrame(nxt, RAW_FACT_SCHEMA).write.parquet(f"{workdir}/raw2")
    files2 = build_star_files(spark, f"{workdir}/raw2", labels, states, rates, f"{workdir}/run2").files
    load_star_files(spark, store, files2)
    ids = sorted(r.immigration_id for r in store.current(FACT).collect())
    assert ids == [1, 2, 3, 4, 11, 12, 13, 14]
    pruned = store.current(FACT, with_partitions=True).where(F.col("arrival_month") == 5)
    assert sorted(r.immigration_id for r in pruned.collect()) == [4, 14]


def test_stage2_duplicate_key_publishes_nothing(spark, workdir):
    rows = raw_fact_rows() + raw_fact_edge_rows()[:3]
    raw, labels, states, rates = _raw_inputs(spark, workdir, rows)
    files = build_star_files(spark, raw, labels, states, rates, f"{workdir}/run1").files
    store = TableStore(spark, f"{workdir}/published")
    with pytest.raises(CheckFailed, match=r"duplicated keys: \[\{'immigration_id': 5, 'n': 2\}\]"):
        load_star_files(spark, store, files)
    assert store.published_versions(FACT) == []
    assert store.current(FACT).count() == 0


def test_stage2_null_key_violates_staging_contract(spark, workdir):
    rows = raw_fact_rows() + raw_fact_edge_rows()[3:]
    raw, labels, states, rates = _raw_inputs(spark, workdir, rows)
    files = build_star_files(spark, raw, labels, states, rates, f"{workdir}/run1").files
    store = TableStore(spark, f"{workdir}/published")
    with pytest.raises(Exception, match="NULL in key column immigration_id"):
        load_star_files(spark, store, files)
    assert store.published_versions(FACT) == []


def test_null_keys_of_two_tables_are_named_together(spark, workdir):
    rows = raw_fact_rows() + raw_fact_edge_rows()[3:]
    raw, labels, states, rates = _raw_inputs(spark, workdir, rows, RATES_CSV)
    files = build_star_files(spark, raw, labels, states, rates, f"{workdir}/run1").files
    store = TableStore(spark, f"{workdir}/published")
    with pytest.raises(CheckFailed) as failed:
        load_star_files(spark, store, files)
    text = str(failed.value)
    assert "1 rows with NULL in key column immigration_id" in text and '"flight_number":"00005"' in text
    assert "1 rows with NULL in key column month" in text and '"avg_rate":7.5' in text
    assert store.state().number == 0

    aside = load_star_files(spark, store, files, set_rejects_aside=True)
    assert aside.published and aside.rejected == {"fact_immigration": 1, "dimension_unemployment": 1}
    assert spark.read.parquet(aside.rejects_path).count() == 2
    assert sorted(r.immigration_id for r in store.current(FACT).collect()) == [1, 2, 3, 4]
    assert store.current(UNEMPLOYMENT).where("month is null").count() == 0
    assert {r[0]: r[3] for r in aside.report_rows()}["fact_immigration"] == 1


def test_published_version_cannot_be_overwritten(spark, workdir):
    raw, labels, states, rates = _raw_inputs(spark, workdir, raw_fact_rows())
    files = build_star_files(spark, raw, labels, states, rates, f"{workdir}/run1").files
    store = TableStore(spark, f"{workdir}/published")
    load_star_files(spark, store, files)
    with pytest.raises(ValueError):
        store.stage(STATES, store.current(STATES), 1)
    assert dt.date(2016, 4, 1) in {r.arrival_date for r in store.current(FACT).collect()}


def test_stage2_untyped_month_violates_staging_contract(spark, workdir):
    raw, labels, states, rates = _raw_inputs(spark, workdir, raw_fact_rows(), RATES_CSV)
    files = build_star_files(spark, raw, labels, states, rates, f"{workdir}/run1").files
    store = TableStore(spark, f"{workdir}/published")
    with pytest.raises(Exception, match="NULL in key column month"):
        load_star_files(spark, store, files)
    assert store.published_versions(UNEMPLOYMENT) == []


def test_command_line_runs_both_stages_and_checks(spark, workdir, capsys):
    from starmart.__main__ import main

    raw, labels, states, rates = _raw_inputs(spark, workdir, raw_fact_rows())
    assert main(["build", "--raw-fact", raw, "--code-lists", labels, "--states", states,
                 "--rates", rates, "--out", f"{workdir}/run1"]) == 0
    assert main(["load", "--run", f"{workdir}/run1", "--published", f"{workdir}/pub"]) == 0
    assert main(["check", "--published", f"{workdir}/pub"]) == 0
    assert '"published": true' in capsys.readouterr().out


def test_one_commit_file_publishes_all_tables_of_a_run(spark, workdir):
    import glob

    raw, labels, states, rates = _raw_inputs(spark, workdir, raw_fact_rows())
    files = build_star_files(spark, raw, labels, states, rates, f"{workdir}/run1").files
    store = TableStore(spark, f"{workdir}/published")
    load_star_files(spark, store, files)
    commits = glob.glob(f"{workdir}/published/_commits/*")
    assert len(commits) == 1
    assert set(store.state().versions) == {"fact_immigration", "dimension_states", "dimension_origin", "dimension_unemployment"}


def test_csv_columns_are_matched_by_header_name(spark, workdir):
    from starmart.plans.tables import build_states, build_unemployment

    states = write_text(workdir, "s.csv", '"abbreviation","STATE"\n"NY","New York"\n"NY","New York"\n')
    got = [tuple(r) for r in build_states(spark, states).collect()]
    assert got == [("New York", "NY")]
    rates = write_text(workdir, "r.csv", "Rate,County,State,Month,Year,Fips\n4.0,A,NY,April,2016,1\n4.0,A,NY,April,2016,2\n6.0,B,NY,April,2016,3\n")
    out = build_unemployment(spark, rates).collect()
    # rows differing only in an extra column both count, as whole-row dedup keeps them
    assert [(r.year, r.month, r.state, round(r.avg_rate, 6)) for r in out] == [(2016, 4, "NY", round(14 / 3, 6))]
    bad = write_text(workdir, "b.csv", "State,Abbrev\nX,Y\n")
    with pytest.raises(ValueError, match="header lacks"):
        build_states(spark, bad)


def test_raw_fact_with_integer_and_text_columns(spark, workdir):
    """Raw numbers stored as int or text convert like doubles; bad text becomes null."""
    from pyspark.sql import functions as F

    base = spark.createDataFrame(raw_fact_rows(), RAW_FACT_SCHEMA)
    odd = base.withColumn("i94cit", F.col("i94cit").cast("int")).withColumn(
        "i94bir", F.when(F.col("cicid") == 1, F.lit("n/a")).otherwise(F.col("i94bir").cast("string"))
    )
    odd.write.parquet(f"{workdir}/raw_odd")
    labels = write_text(workdir, "labels.SAS", LABEL_TEXT)
    states = write_text(workdir, "states.csv", STATES_CSV)
    rates = write_text(workdir, "rates.csv", RATES_CSV_CLEAN)
    res = build_star_files(spark, f"{workdir}/raw_odd", labels, states, rates, f"{workdir}/run")
    fact = {r.immigration_id: r for r in spark.read.parquet(res.files.path(FACT.name)).collect()}
    assert fact[1].country_of_birth == 101 and fact[1].respondent_age is None
    assert fact[2].respondent_age == 41
    assert res.rejects["rejected_i94bir"] == 1
    missing = base.drop("fltno")
    missing.write.parquet(f"{workdir}/raw_missing")
    with pytest.raises(ValueError, match="fltno"):
        build_star_files(spark, f"{workdir}/raw_missing", labels, states, rates, f"{workdir}/run2")
