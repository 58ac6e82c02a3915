"""Plan shape: pushdown, pruning, no Python in the hot path, join strategies."""

from __future__ import annotations

import pytest

from starmart.operators.merge import insert_only, upsert
from starmart.plans import queries as Q
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def no_python(text: str) -> bool:
    return not any(t in text for t in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"))


def test_fact_build_is_one_projection_without_python(spark):
    text = plan(Q.fact_build(spark, SF_SMALL))
    assert no_python(text)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate" in Q.fact_build(spark, SF_SMALL)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_lookup_filter_reaches_the_scan(spark):
    df = Q.role_playing_lookup(spark, SF_SMALL)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(n_name,NATION_7)" in text
    assert "BroadcastHashJoin" in text
    assert no_python(text)


@pytest.mark.parametrize("name", ["insert_only_fact", "scd1_single_key", "scd1_composite_key"])
def test_merges_never_use_null_aware_anti_join(spark, name):
    text = plan(Q.QUERIES[name](spark, SF_SMALL))
    assert "LeftAnti" in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "isNullAwareAntiJoin=true" not in text and ", true)" not in text.split("LeftAnti")[1].split("\n")[0]


def test_small_batch_does_not_shuffle_the_target(spark):
    target = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    batch = target.limit(10)
    text = plan(insert_only(target, batch, ["o_orderkey"]).inserted)
    assert "LeftSemi" in text and "SortMergeJoin" not in text


def test_large_batch_takes_the_sort_merge_path(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
        text = plan(upsert(target, target, ["c_custkey"], max_broadcast_rows=10).kept)
        assert "SortMergeJoin" in text and "BroadcastExchange" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_profile_aggregates_partially_before_the_shuffle(spark):
    text = plan(Q.dq_duplicate_keys(spark, SF_SMALL))
    assert "partial_count" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_report_profiles_each_table_once(spark):
    text = plan(Q.dq_report(spark, SF_SMALL))
    assert text.count("Exchange hashpartitioning") == len(Q._REPORTED)


def test_batch_key_range_reaches_the_target_scan(spark):
    target = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    batch = target.where("o_orderkey >= 1400")
    text = insert_only(target, batch, ["o_orderkey"]).inserted._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(o_orderkey,1400)" in text
    assert "LessThanOrEqual(o_orderkey,1499)" in text


def test_fact_clustering_is_one_rebalance_shuffle_with_a_local_sort(spark):
    from starmart.plans.tables import build_fact, cluster_by_arrival_month, with_arrival_partition

    df = cluster_by_arrival_month(with_arrival_partition(Q.fact_build(spark, SF_SMALL)))
    text = plan(df)
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    assert "rangepartitioning" not in text
    assert "Sort [arrival_year" in text


def test_hot_month_is_split_across_tasks(spark, workdir):
    """A month holding a third of the rows (one id repeated) is written by several tasks."""
    import glob

    from pyspark.sql import functions as F

    from starmart.plans.tables import cluster_by_arrival_month

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(300000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("immigration_id"),
            F.when(F.col("id") % 3 == 0, F.lit(2016)).otherwise(2000 + F.col("id") % 10).alias("arrival_year"),
            F.when(F.col("id") % 3 == 0, F.lit(4)).otherwise(1 + F.col("id") % 12).alias("arrival_month"),
            (F.col("id") * 7).alias("v"),
        )
        out = f"{workdir}/fact"
        cluster_by_arrival_month(df).write.partitionBy("arrival_year", "arrival_month").parquet(out)
        hot = glob.glob(f"{out}/arrival_year=2016/arrival_month=4/*.parquet")
        assert len(hot) > 1
        assert spark.read.parquet(out).count() == 300000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_large_batch_also_prunes_the_target_key_range(spark):
    target = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    batch = target.where("o_orderkey >= 1400")
    df = insert_only(target, batch, ["o_orderkey"], max_broadcast_rows=0).inserted
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "LessThanOrEqual(o_orderkey,1499)" in text


def test_broadcast_needs_both_bounds(spark):
    from pyspark.sql import functions as F

    from starmart.operators.joins import lookup_join, maybe_broadcast, size_of

    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    rows, size = size_of(nation)
    # 25 rows of (int, string, int): 8 bytes per field and header plus the text bytes.
    text_bytes = nation.agg(F.sum(F.octet_length("n_name"))).first()[0]
    assert (rows, size) == (25, 25 * 32 + text_bytes)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastExchange" in plan(
            lookup_join(spark.read.parquet(f"{SF_SMALL}/customer.parquet"), nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
        )
        # Few rows but over the byte bound: left to the planner.
        wide = maybe_broadcast(nation, max_rows=100, max_bytes=size - 1)
        joined = spark.read.parquet(f"{SF_SMALL}/customer.parquet").join(
            wide.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", "left"
        )
        assert "BroadcastExchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_upsert_collapses_a_hot_staging_key_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
        hot = target.withColumn("c_custkey", F.lit(1).cast("bigint"))  # every row repeats key 1
        staging = target.unionByName(hot)
        m = upsert(target, staging, ["c_custkey"], max_broadcast_rows=10)
        text = plan(m.kept)
        right = text.split("LeftAnti")[1]
        # partial aggregate, one exchange, final aggregate on the staging keys
        assert right.count("HashAggregate(keys=[c_custkey") == 2
        # one per join side for the join, directly below its sort, and one for the aggregate
        assert right.count("Exchange hashpartitioning(c_custkey") == 3
        assert m.kept.count() == 0
        assert m.result.count() == staging.distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_upsert_splits_a_hot_target_key(spark):
    from pyspark.sql import functions as F

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 60000, 1, 8)
        target = ids.select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        staging = ids.where("id % 2 = 1").select(F.col("id").alias("k"), F.lit("new").alias("v")).where("k != 7")
        kept = upsert(target, staging, ["k"], max_broadcast_rows=10).kept
        assert kept.agg(F.count(F.lit(1))).first()[0] == 40000 + 10000
        done = kept.select("k", "v")
        done.collect()
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in small:
            spark.conf.unset(k)


def test_roll_ups_are_joined_without_a_sizing_job(spark, monkeypatch):
    from starmart.operators import joins

    sized = []
    real = joins.size_of
    monkeypatch.setattr(joins, "size_of", lambda df: sized.append(df.columns) or real(df))
    for name in ("arrivals_vs_rate", "star_arrivals_vs_rate"):
        Q.QUERIES[name](spark, SF_SMALL)
    assert not any("avg_rate" in columns for columns in sized)


def test_size_counts_wide_decimals_and_nested_values(spark):
    from starmart.operators.joins import size_of

    df = spark.createDataFrame(
        [(1, ["ab", "c"], {"k": 1}, 1.5)],
        "id int, tags array<string>, attrs map<string,int>, amount double",
    ).selectExpr("id", "tags", "attrs", "cast(amount as decimal(38,6)) as amount")
    rows, size = size_of(df)
    # 8 per field and header, the JSON text of the array and the map, 16 for the wide decimal
    assert (rows, size) == (1, 8 * 5 + len('["ab","c"]') + len('{"k":1}') + 16)
    assert size_of(df.limit(0)) == (0, 0)
