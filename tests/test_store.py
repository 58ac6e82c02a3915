"""The published store: commits, key filters, key buckets, compaction, retirement."""

from __future__ import annotations

import glob
import json
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from starmart.operators import keyfilter
from starmart.operators.quality import content_checksum
from starmart.plans import publish
from starmart.plans.commits import CommitLog, PublishConflict, State
from starmart.plans.publish import TableStore
from starmart.schemas import FACT, FACT_SCHEMA, TableSpec

CUSTOMERS = TableSpec("customers", StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("rate", DoubleType())]), ("id",))
PAIRS = TableSpec("pairs", StructType([StructField("a", IntegerType()), StructField("b", StringType()), StructField("v", StringType())]), ("a", "b"))


def facts(spark, ids, note="x"):
    """Fact rows with the given ids, spread over five months and one without a date."""
    day = F.date_add(F.lit("2016-01-15").cast("date"), (F.pmod("immigration_id", F.lit(5)) * 31).cast("int"))
    day = F.when(F.col("immigration_id") % 97 != 0, day)
    rows = spark.createDataFrame([(i,) for i in ids], "immigration_id long")
    fixed = {f.name: F.lit(None).cast(f.dataType) for f in FACT_SCHEMA.fields if f.name != "immigration_id"}
    fixed |= {"arrival_date": day, "gender": F.lit(note), "admission_number": F.col("immigration_id") * 3}
    return rows.withColumns(fixed).select(*FACT_SCHEMA.fieldNames())


def insert(store, ids, note="x"):
    staged = store.stage_insert(FACT, facts(store.spark, ids, note), store.state())
    assert not staged.problems
    store.publish(staged)
    return staged


def ids_of(df):
    return sorted(r.immigration_id for r in df.select("immigration_id").collect())


# -- commits -------------------------------------------------------------------


def test_of_two_runs_from_one_state_one_wins(spark, workdir):
    store = TableStore(spark, f"{workdir}/store")
    insert(store, range(10))
    state = store.state()
    first = store.stage_insert(FACT, facts(spark, range(5, 20)), state)
    second = store.stage_insert(FACT, facts(spark, range(8, 30)), state)
    store.publish(second)
    with pytest.raises(PublishConflict, match="commit 2"):
        store.publish(first)
    assert ids_of(store.current(FACT)) == list(range(30))  # no id twice
    again = store.stage_insert(FACT, facts(spark, range(5, 20)), store.state())
    assert again.written_rows == 0
    store.publish(again)
    assert store.published_versions(FACT) == [1, 2, 3]


def test_a_commit_number_is_given_once(spark, workdir):
    def add(k):
        log = CommitLog(spark, f"{workdir}/log")
        try:
            log.add(State(1, {"t": [k]}))
            return k
        except PublishConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [k for k in pool.map(add, range(24)) if k is not None]
    log = CommitLog(spark, f"{workdir}/log")
    assert len(won) == 1 and log.numbers() == [1] and log.latest().versions == {"t": won}
    assert glob.glob(f"{workdir}/log/.*.draft") == []


def test_a_run_that_fails_midway_leaves_no_trace(spark, workdir):
    store = TableStore(spark, f"{workdir}/store")
    insert(store, range(10))
    store.stage_insert(FACT, facts(spark, range(100)), store.state())  # staged, never published
    assert ids_of(store.current(FACT)) == list(range(10))
    assert TableStore(spark, f"{workdir}/store").state() == store.state()
    state = store.state()
    assert State.from_json(state.to_json()) == state and json.loads(state.to_json())["number"] == 1


def test_versions_of_different_states_are_not_published_together(spark, workdir):
    store = TableStore(spark, f"{workdir}/store")
    early = store.stage_insert(FACT, facts(spark, range(3)), store.state())
    store.publish(early)
    late = store.stage_upsert(CUSTOMERS, spark.createDataFrame([(1, "a", 1.0)], CUSTOMERS.schema), store.state())
    with pytest.raises(ValueError, match="different states"):
        store.publish(early, late)


# -- key filters ---------------------------------------------------------------


def test_only_batches_that_may_hold_a_key_are_read(spark, workdir):
    store = TableStore(spark, f"{workdir}/store")
    rng = random.Random(1)
    ids = rng.sample(range(10**9), 4000)  # random order: every batch spans the whole key range
    batches = [ids[k::4] for k in range(4)]
    for mine in batches:
        insert(store, mine)
    state = store.state()
    fresh = [i for i in rng.sample(range(10**9), 60) if i not in set(ids)]
    again = rng.sample(batches[2], 20)
    staging = facts(spark, fresh + again, "late")
    target = store.target_for(FACT, staging, state)
    read = {f.split("/batch=")[1].split("/")[0] for f in target.inputFiles()}
    assert "3" in read and len(read) < 4  # the other batches are skipped, but for rare false hits
    staged = insert(store, fresh + again, "late")
    plain = facts(spark, fresh + again).join(spark.createDataFrame([(i,) for i in ids], "immigration_id long"), "immigration_id", "left_anti")
    written = store.read_units(FACT, staged.units)
    assert ids_of(written) == ids_of(plain) == sorted(fresh)
    assert ids_of(store.current(FACT)) == sorted(ids + fresh)
    assert store.current(FACT).where("gender = 'late'").count() == len(fresh)
    # no batch may hold a key: nothing of the fact is read
    assert store.batches_holding(FACT, facts(spark, []), state) == []


def test_many_keys_are_joined_without_the_filter(spark, workdir, monkeypatch):
    store = TableStore(spark, f"{workdir}/store")
    insert(store, range(0, 100))
    monkeypatch.setattr(publish, "fits", lambda df: False)
    assert store.batches_holding(FACT, facts(spark, [5]), store.state()) is None
    insert(store, range(50, 150))
    assert ids_of(store.current(FACT)) == list(range(150))


@pytest.mark.parametrize("n", [1, 7, 1000, 30000])
def test_key_filter_never_misses_and_rarely_errs(spark, n):
    words = keyfilter.filter_words(n)
    assert words & (words - 1) == 0 and 24 * n <= 64 * words < 48 * n + 129
    held = spark.range(n).select((F.col("id") * 7919).alias("k"), F.lit(None).cast("string").alias("other"))
    table = keyfilter.key_filter(held.unionByName(held), ["k"], words).cache()
    assert keyfilter.may_hold(table, words, held, ["k"]).count() == n
    others = spark.range(20000).select((F.col("id") * 7919 + 13).alias("k"))
    assert keyfilter.may_hold(table, words, others, ["k"]).count() <= 60
    table.unpersist()


# -- key buckets ---------------------------------------------------------------


def test_one_changed_key_rewrites_one_bucket(spark, workdir):
    store = TableStore(spark, f"{workdir}/store", bucket_rows=20)
    rows = [(i, f"name {i}", i / 7) for i in range(300)] + [(1000, None, None)]
    store.publish(store.stage_upsert(CUSTOMERS, spark.createDataFrame(rows, CUSTOMERS.schema), store.state()))
    first = store.state()
    assert first.buckets["customers"] == 16 and len(first.of("customers")) == 16
    changed = [r if r[0] != 42 else (42, "another", r[2]) for r in rows]
    staged = store.stage_upsert(CUSTOMERS, spark.createDataFrame(changed, CUSTOMERS.schema), first)
    assert len(staged.units) == 1 and staged.written_rows < 60
    store.publish(staged)
    second = store.state()
    kept = set(first.of("customers")) & set(second.of("customers"))
    assert len(kept) == 15 and len(second.of("customers")) == 16
    assert sorted(map(tuple, store.current(CUSTOMERS).collect())) == sorted(changed)
    # nothing changed: no bucket is written, and the old rows stay
    same = store.stage_upsert(CUSTOMERS, spark.createDataFrame(changed[:50], CUSTOMERS.schema), second)
    assert same.units == [] and not same.problems
    store.publish(same)
    assert store.current(CUSTOMERS).count() == 301 and store.published_versions(CUSTOMERS) == [1, 2, 3]
    # a state read before is still there
    assert store.current(CUSTOMERS, state=first).where("id = 42").first().name == "name 42"


def test_buckets_grow_with_the_table(spark, workdir):
    store = TableStore(spark, f"{workdir}/store", bucket_rows=10)
    for n in (5, 200, 201):
        store.publish(store.stage_upsert(CUSTOMERS, spark.range(n).selectExpr("id", "'x' as name", "1d as rate"), store.state()))
        assert store.current(CUSTOMERS).count() == n
    assert store.state().buckets["customers"] == 32


def test_upsert_by_buckets_equals_a_plain_upsert(spark, workdir):
    rng = random.Random(5)
    store, want = TableStore(spark, f"{workdir}/store", bucket_rows=8), {}
    for _ in range(4):
        batch = {(rng.randrange(9), rng.choice("abcdefgh")): rng.choice(["u", "v", None]) for _ in range(rng.randrange(1, 40))}
        rows = [(*k, v) for k, v in batch.items()] * 2  # staging rows repeat
        staged = store.stage_upsert(PAIRS, spark.createDataFrame(rows, PAIRS.schema), store.state())
        assert not staged.problems
        store.publish(staged)
        want |= batch
    assert sorted(map(str, (tuple(r) for r in store.current(PAIRS).collect()))) == sorted(str((*k, v)) for k, v in want.items())


def test_two_rows_of_one_key_stop_an_upsert(spark, workdir):
    store = TableStore(spark, f"{workdir}/store", bucket_rows=8)
    store.publish(store.stage_upsert(CUSTOMERS, spark.createDataFrame([(i, "a", 1.0) for i in range(40)], CUSTOMERS.schema), store.state()))
    bad = store.stage_upsert(CUSTOMERS, spark.createDataFrame([(7, "a", 1.0), (7, "b", 1.0)], CUSTOMERS.schema), store.state())
    assert bad.problems[0] == "1 duplicated keys"


# -- compaction ----------------------------------------------------------------


def test_compaction_keeps_content_and_bounds_files(spark, workdir):
    store = TableStore(spark, f"{workdir}/store")
    for k in range(4):
        insert(store, range(k, 400, 4), f"batch {k}")
    before, rows = store.state(), sorted(map(str, store.current(FACT).collect()))
    assert sum(u.files for u in before.of(FACT.name)) >= 4 * 6
    after = store.compact(FACT)
    assert after == store.state() and after.number == before.number + 1
    assert sorted(map(str, store.current(FACT).collect())) == rows
    assert sorted(u.files for u in after.of(FACT.name)) == [1] * 6  # five months, one without a date
    assert len(after.filters) == 1
    assert store.current(FACT, with_partitions=True).where("arrival_month = 2").count() == len([i for i in range(400) if i % 5 == 1 and i % 97])
    assert store.compact(FACT) == after  # nothing left to do
    # ids are still found by the filter of the packed batch
    staged = insert(store, range(390, 410))
    assert staged.written_rows == 10 and ids_of(store.current(FACT)) == list(range(410))


def test_compaction_fills_bins_and_leaves_large_directories(spark, workdir):
    store = TableStore(spark, f"{workdir}/store")
    insert(store, range(0, 4000))
    for k in range(4):
        insert(store, range(10000 + 10 * k, 10010 + 10 * k))
    sizes = [u.bytes for u in store.state().of(FACT.name)]
    big, little = max(sizes), sorted(sizes)[8]
    after = store.compact(FACT, file_bytes=int(2.5 * little))
    kept = [u for u in after.of(FACT.name) if u.version == 1 and u.bytes > 1.25 * little]
    assert kept and big in [u.bytes for u in kept]  # large directories stay where they are
    packed = [u for u in after.of(FACT.name) if u.version == 6]
    assert packed and all(1 < u.files <= 3 for u in packed if u.rows > 12)
    assert ids_of(store.current(FACT)) == [*range(4000), *range(10000, 10040)]
    assert sum(u.rows for u in after.of(FACT.name)) == 4040


def test_compaction_beside_a_load_conflicts(spark, workdir):
    store = TableStore(spark, f"{workdir}/store")
    insert(store, range(10))
    insert(store, range(10, 20))
    staged = store.stage_insert(FACT, facts(spark, range(15, 30)), store.state())
    store.compact(FACT)
    with pytest.raises(PublishConflict):
        store.publish(staged)
    assert ids_of(store.current(FACT)) == list(range(20))


def test_retirement_removes_only_what_no_kept_commit_names(spark, workdir):
    store = TableStore(spark, f"{workdir}/store", bucket_rows=8)
    for k in range(3):
        fact = store.stage_insert(FACT, facts(spark, range(10 * k, 10 * k + 10)), store.state())
        rows = [(i, f"v{k}", 0.5) for i in range(20)]
        store.publish(fact, store.stage_upsert(CUSTOMERS, spark.createDataFrame(rows, CUSTOMERS.schema), store.state()))
    store.compact(FACT)
    store.stage_insert(FACT, facts(spark, range(90, 95)), store.state())  # abandoned
    content = sorted(map(str, store.current(FACT).collect())), sorted(map(str, store.current(CUSTOMERS).collect()))
    assert store.retire(keep=1) == []  # all of it is young
    removed = store.retire(keep=1, older_than_s=0)
    assert sorted(r.split("/attempt=")[0] for r in removed if r.startswith("fact")) == [f"fact_immigration/batch={n}" for n in (2, 3, 5)]  # the one file without a date was not packed
    assert sorted(r.split("/attempt=")[0] for r in removed if r.startswith("customers")) == ["customers/version=1", "customers/version=2"]
    assert len([r for r in removed if r.startswith("_keys")]) == 3
    assert store.log.numbers() == [4]
    assert (sorted(map(str, store.current(FACT).collect())), sorted(map(str, store.current(CUSTOMERS).collect()))) == content
    insert(store, range(25, 40))
    assert ids_of(store.current(FACT)) == list(range(40))


# -- content -------------------------------------------------------------------


def test_a_changed_cell_with_equal_counts_is_caught(spark, workdir, monkeypatch):
    a = spark.createDataFrame([(1, "a", 0.5), (2, None, None), (3, "c", 1.5)], CUSTOMERS.schema)
    b = spark.createDataFrame([(1, "a", 0.5), (2, None, None), (3, "C", 1.5)], CUSTOMERS.schema)
    columns = CUSTOMERS.schema.fieldNames()

    def checksum(df):
        return df.agg(content_checksum(columns)).first()[0]

    assert checksum(a) != checksum(b)
    assert checksum(a) == checksum(a.repartition(3)) == checksum(a.orderBy(F.desc("id")).coalesce(1))
    assert checksum(a) != checksum(a.unionByName(a.limit(1)))

    plain = publish.write_parquet_observed

    def damaged(df, path, **more):
        plain(df.withColumn("name", F.when(F.col("id") == 3, "?").otherwise(F.col("name"))), path, partition_by=more["partition_by"])
        return plain(df, path + "-as-sent", **more)

    monkeypatch.setattr(publish, "write_parquet_observed", damaged)
    staged = TableStore(spark, f"{workdir}/store").stage(CUSTOMERS, a, 1)
    assert staged.written_rows == staged.read_rows == 3
    assert staged.problems == ["rows read back differ from the rows written"]


# -- the maintained mart -------------------------------------------------------


def test_mart_equals_a_recount_and_reads_only_the_batch(spark, workdir, monkeypatch):
    from starmart.plans import marts
    from starmart.schemas import ARRIVALS

    store = TableStore(spark, f"{workdir}/store", bucket_rows=4)
    states = F.element_at(F.array(F.lit("NY"), F.lit("CA"), F.lit(None), F.lit("")), (F.col("immigration_id") % 4 + 1).cast("int"))
    read = []
    plain = marts.monthly_arrivals
    monkeypatch.setattr(marts, "monthly_arrivals", lambda fact: read.append(fact.inputFiles()) or plain(fact))
    for lo, hi in ((0, 120), (90, 200), (150, 160), (0, 260)):
        state = store.state()
        fact = store.stage_insert(FACT, facts(spark, range(lo, hi)).withColumn("address_state_code", states), state)
        mart = marts.stage_arrivals(store, fact)
        assert not fact.problems and not mart.problems
        store.publish(fact, mart)
        want = sorted(map(str, plain(store.current(FACT)).collect()))
        assert sorted(map(str, marts.published_arrivals(store).collect())) == want
    assert len({f.split("/batch=")[1].split("/")[0] for f in read[1]}) == 1  # the second batch alone
    assert read[2] == [] and store.state().versions[ARRIVALS.name] == [1, 2, 3, 4]
