"""The query contract on the driver's test tables (Spark side).

The test tables hold a TPC-H-like star schema, so every operator is aimed at
it: raw-shaped inputs are derived from the tables with Spark (see
``starmart.sources.derived``), then the library's own builders, merges and
checks run over the whole tables. Each function takes (spark, sf_dir) and
returns a DataFrame whose columns match the oracle SQL of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starmart.functions.casts import cast_columns, rename_columns
from starmart.functions.dates import compact_date, epoch_day_to_date, month_name_to_number
from starmart.operators.dedup import distinct_rows, grouped_average, last_value, row_counts
from starmart.operators.joins import lookup_join
from starmart.operators.merge import insert_only, upsert
from starmart.operators.quality import (
    check_report,
    key_profile,
    null_key_count,
    null_key_rows,
    write_parquet_observed,
)
from starmart.plans.marts import arrivals_lookup, top_n
from starmart.plans.marts import arrivals_vs_rate as mart_arrivals_vs_rate
from starmart.plans.publish import TableStore
from starmart.plans.queries_store import STORE_QUERIES
from starmart.plans.stages import build_star_files, load_star_files
from starmart.plans.tables import (
    build_fact,
    build_origin,
    build_states,
    build_unemployment,
    cluster_by_arrival_month,
    with_arrival_partition,
)
from starmart.schemas import FACT, REGISTRY
from starmart.session import scratch_path
from starmart.sources.derived import (
    raw_arrivals,
    rate_sheet,
    table,
    write_csv,
    write_label_file,
)
from starmart.sources.labels import label_blocks, label_entries
from starmart.sources.readers import read_csv
from starmart.sources.staging import load_staging

# Fixed parameters of the test scenarios (not sampling: every row of each
# table flows into the target, the staging batch, or both).
HISTORY_END = "1999-01-01"      # target holds rows before this date
BATCH_START = "1998-07-01"      # the staging batch holds rows from this date on
CUSTOMER_TARGET_BELOW = 6000.0  # target customers have c_acctbal below this
CUSTOMER_BATCH_FROM = 3000.0    # staging customers have c_acctbal from this on
LOOKUP_NATION = "NATION_7"      # constant of the role-playing lookup
MISSING_REGION = 4              # nations of this region are absent from the lookup dimension


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"),
        "o_orderpriority",
    )


def _lineitem(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.withColumn("l_shipdate", F.to_date("l_shipdate"))


# --- sources and projections -------------------------------------------------


def fact_scan_project(spark: SparkSession, d: str) -> DataFrame:
    return _orders(spark, d).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )


def epoch_day_to_date_q(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1960-01-01").cast("date")) + (
        F.col("o_orderkey") % 4
    ) * 0.25
    day_number = F.when(F.col("o_orderkey") % 11 != 0, days)
    raw = o.select("o_orderkey", day_number.alias("day_number"))
    return raw.select("o_orderkey", "day_number", epoch_day_to_date("day_number").alias("arrival_date"))


def compact_date_ymd(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 13 == 0, F.lit("n/a")).otherwise(
        F.date_format("o_orderdate", "yyyyMMdd")
    )
    raw = o.select("o_orderkey", text.alias("date_file_text"))
    return raw.select(
        "o_orderkey", "date_file_text", compact_date("date_file_text", "yyyyMMdd").alias("date_file")
    )


def compact_date_mdy(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("D/S")).otherwise(
        F.date_format(F.date_add(F.to_date("o_orderdate"), 180), "MMddyyyy")
    )
    raw = o.select("o_orderkey", text.alias("stay_text"))
    return raw.select(
        "o_orderkey",
        "stay_text",
        compact_date("stay_text", "MMddyyyy").alias("permitted_to_stay_until"),
    )


def month_name_to_number_q(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    name = F.date_format("o_orderdate", "MMMM")
    text = (
        F.when(F.col("o_orderkey") % 17 == 0, F.concat(name, F.lit("x")))
        .when(F.col("o_orderkey") % 3 == 0, F.upper(name))
        .otherwise(name)
    )
    raw = o.select("o_orderkey", text.alias("month_name"))
    return raw.select("o_orderkey", "month_name", month_name_to_number("month_name").alias("month"))


def cast_columns_q(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    raw = o.select(
        "o_orderkey",
        (F.col("o_orderkey") + 0.75).alias("key_fraction"),
        (-F.col("o_totalprice")).alias("negative_price"),
        (F.col("o_orderkey") + 5000000000).cast("double").alias("admission"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("n/a"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("code_text"),
    )
    typed = cast_columns(
        raw.withColumn("admission_as_int", F.col("admission")),
        {
            "key_fraction": "int",
            "negative_price": "int",
            "admission": "bigint",
            "code_text": "int",
            "admission_as_int": "int",
        },
    )
    return typed


def rename_columns_q(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    mapping = {
        "c_custkey": "customer_id",
        "c_name": "customer_name",
        "c_nationkey": "nation_code",
        "c_acctbal": "c_acctbal",
        "c_mktsegment": "segment",
        "c_phone": "phone",
    }
    return rename_columns(c, mapping)


_PART_CSV = StructType(
    [
        StructField("p_partkey", StringType()),
        StructField("p_name", StringType()),
        StructField("p_brand", StringType()),
        StructField("p_type", StringType()),
        StructField("p_size", StringType()),
        StructField("p_retailprice", StringType()),
    ]
)


def csv_scan_typed(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    path = write_csv(
        p.select(*[F.col(c).cast("string").alias(c) for c in _PART_CSV.fieldNames()]),
        scratch_path(spark, "part-csv"),
    )
    return cast_columns(
        read_csv(spark, path, _PART_CSV),
        {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"},
    )


def _brand_block():
    return F.lower(F.regexp_replace("p_brand", "#", ""))


def label_blocks_q(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    path = write_label_file(
        p,
        block=_brand_block(),
        code=F.col("p_partkey"),
        label=F.col("p_name"),
        order=[F.col("p_partkey")],
        path=scratch_path(spark, "part-labels"),
    )
    return label_blocks(spark, path)


def label_last_wins(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    path = write_label_file(
        c,
        block=F.lit("nation_customer"),
        code=F.col("c_nationkey"),
        label=F.col("c_name"),
        order=[F.col("c_custkey")],
        path=scratch_path(spark, "customer-labels"),
    )
    entries = label_entries(spark, path)
    return last_value(
        entries, ["block", "code"], "label", F.struct("file", "block_pos", "line_pos")
    )


def distinct_rows_q(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return distinct_rows(c.unionByName(c))


# --- roll-up ------------------------------------------------------------------


def _rounded(c: str) -> Column:
    """Six decimals, nudged off exact ties, which engines round either way."""
    return F.round(F.col(c) + 1e-8, 6)


def rate_rollup(spark: SparkSession, d: str) -> DataFrame:
    path = write_csv(rate_sheet(spark, d), scratch_path(spark, "rate-csv"))
    return build_unemployment(spark, path).withColumn("avg_rate", _rounded("avg_rate"))


# --- merges -------------------------------------------------------------------


def _orders_target_staging(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = _orders(spark, d)
    target = o.where(F.col("o_orderdate") < F.lit(HISTORY_END).cast("date"))
    batch = o.where(F.coalesce(F.col("o_orderdate") >= F.lit(BATCH_START).cast("date"), F.lit(True))).withColumn(
        "o_orderstatus",
        F.when(F.col("o_orderdate") < F.lit(HISTORY_END).cast("date"), F.lit("X")).otherwise(
            F.col("o_orderstatus")
        ),
    )
    return target, batch.unionByName(batch)


def _customer_target_staging(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "customer")
    target = c.where(F.col("c_acctbal") < CUSTOMER_TARGET_BELOW)
    batch = c.where(F.coalesce(F.col("c_acctbal") >= CUSTOMER_BATCH_FROM, F.lit(True))).withColumn(
        "c_mktsegment", F.lower("c_mktsegment")
    )
    return target, batch.unionByName(batch)


def _lineitem_target_staging(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    li = _lineitem(spark, d)
    target = li.where(F.col("l_shipdate") < F.lit(HISTORY_END).cast("date"))
    batch = li.where(F.coalesce(F.col("l_shipdate") >= F.lit(BATCH_START).cast("date"), F.lit(True))).withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )
    return target, batch.unionByName(batch)


def insert_only_fact(spark: SparkSession, d: str) -> DataFrame:
    target, staging = _orders_target_staging(spark, d)
    return insert_only(target, staging, ["o_orderkey"]).result


def scd1_single_key(spark: SparkSession, d: str) -> DataFrame:
    target, staging = _customer_target_staging(spark, d)
    return upsert(target, staging, ["c_custkey"]).result


def scd1_composite_key(spark: SparkSession, d: str) -> DataFrame:
    target, staging = _lineitem_target_staging(spark, d)
    return upsert(target, staging, ["l_orderkey", "l_linenumber"]).result


def load_all(spark: SparkSession, d: str) -> DataFrame:
    t, s = _orders_target_staging(spark, d)
    out = insert_only(t, s, ["o_orderkey"]).stats("orders")
    t, s = _customer_target_staging(spark, d)
    out = out.unionByName(upsert(t, s, ["c_custkey"]).stats("customer"))
    t, s = _lineitem_target_staging(spark, d)
    return out.unionByName(upsert(t, s, ["l_orderkey", "l_linenumber"]).stats("lineitem"))


# --- lookups ------------------------------------------------------------------


def role_playing_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Lineitem facts with the nation dimension in two roles, filtered on one.

    The label filter is applied to the customer-role nation first, so the
    customer and order sides shrink before they meet the lineitem scan.
    """
    nation = table(spark, d, "nation")
    cust_nation = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation")
    ).where(F.col("customer_nation") == LOOKUP_NATION)
    supp_nation = nation.select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation")
    )
    customers = lookup_join(
        table(spark, d, "customer").select("c_custkey", "c_nationkey"),
        cust_nation,
        "c_nationkey",
        "inner",
    ).select(F.col("c_custkey").alias("o_custkey"), "customer_nation")
    orders = lookup_join(
        table(spark, d, "orders").select(
            "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate")
        ),
        customers,
        "o_custkey",
        "inner",
    ).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "customer_nation")
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"
    )
    facts = li.join(orders, "l_orderkey", "inner")
    suppliers = lookup_join(
        table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"),
        supp_nation,
        "s_nationkey",
        "left",
    ).select("l_suppkey", "supplier_nation")
    return lookup_join(facts, suppliers, "l_suppkey", "left").select(
        "l_orderkey",
        "l_linenumber",
        "o_orderdate",
        "customer_nation",
        "supplier_nation",
        "l_extendedprice",
    )


def state_lookup(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation")
    dim = nation.where(F.col("n_regionkey") != MISSING_REGION).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state_name")
    )
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return lookup_join(c, dim, "c_nationkey", "left").select(
        "c_custkey", "c_name", "c_nationkey", "state_name"
    )


def lookup_top10(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return top_n(o, 10, [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()])


def arrivals_vs_rate(spark: SparkSession, d: str) -> DataFrame:
    """Orders per month beside the events' average value of the same calendar month.

    Both sides are aggregated before the join (so only month-sized rows meet);
    the years differ between the tables, so they meet on the month alone.
    """
    o = table(spark, d, "orders")
    arrivals = o.groupBy(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.count(F.lit(1)).alias("arrivals"))
    e = table(spark, d, "events")
    rates = grouped_average(e.select(F.month("ts").alias("month"), "value"), ["month"], "value", "avg_rate")
    return arrivals.join(rates, "month", "left").select(
        "year", "month", "arrivals", _rounded("avg_rate").alias("avg_rate")
    )


# --- checks -------------------------------------------------------------------


def _orders_with_null_keys(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderkey")).alias("o_orderkey"),
        F.when(F.col("o_orderkey") % 89 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_totalprice",
    )


def dq_null_keys(spark: SparkSession, d: str) -> DataFrame:
    n = null_key_count(_orders_with_null_keys(spark, d), ["o_orderkey", "o_custkey"])
    return n.select(
        F.lit("orders").alias("table_name"),
        "null_key_rows",
        (F.col("null_key_rows") == 0).alias("passed"),
    )


def dq_null_key_sample(spark: SparkSession, d: str) -> DataFrame:
    """The offending row shown with a failed null check: the first one in key order."""
    orders = _orders_with_null_keys(spark, d)
    order = [F.col(c).asc_nulls_first() for c in ("o_orderkey", "o_custkey", "o_totalprice")]
    return null_key_rows(orders, ["o_orderkey", "o_custkey"]).orderBy(*order).limit(1)


def dq_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    p = key_profile(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
    return p.select(
        F.lit("lineitem").alias("table_name"),
        "rows",
        "distinct_keys",
        "duplicate_keys",
        "duplicate_rows",
        (F.col("duplicate_keys") == 0).alias("passed"),
    )


_COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def row_counts_q(spark: SparkSession, d: str) -> DataFrame:
    return row_counts({t: table(spark, d, t) for t in _COUNTED})


def write_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write orders partitioned by year and month, observe the count, read counts and content back."""
    o = _orders(spark, d).withColumns(
        {"order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate")}
    )
    o = o.hint("rebalance", "order_year", "order_month")  # few files per month, not tasks x months
    path = scratch_path(spark, "orders-roundtrip")
    metrics = write_parquet_observed(o, path, partition_by=["order_year", "order_month"])
    written = int(metrics["rows"])
    back = spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("read_rows"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("read_price"),
        F.sum(F.col("o_orderkey") * (F.col("order_year") * 12 + F.col("order_month"))).alias("read_months"),
    )
    return back.select(
        F.lit("orders").alias("table_name"),
        F.lit(written).cast("bigint").alias("written_rows"),
        "read_rows",
        "read_price",
        "read_months",
        (F.col("read_rows") == F.lit(written)).alias("passed"),
    )


_REPORTED = {
    "orders": ["o_orderkey"],
    "customer": ["c_custkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "nation": ["n_nationkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
}


def dq_report(spark: SparkSession, d: str) -> DataFrame:
    return check_report({t: (table(spark, d, t), k) for t, k in _REPORTED.items()})


# --- staging and the table builds ---------------------------------------------


def fact_build(spark: SparkSession, d: str) -> DataFrame:
    return build_fact(raw_arrivals(spark, d))


def staging_load(spark: SparkSession, d: str) -> DataFrame:
    """Stage-1 fact files written partitioned, then loaded under the fact contract."""
    fact = cluster_by_arrival_month(with_arrival_partition(build_fact(raw_arrivals(spark, d))))
    path = scratch_path(spark, "fact-files")
    fact.write.partitionBy(*FACT.partition_by).parquet(path)
    return load_staging(spark, path, FACT)


def origin_build(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    path = write_label_file(
        n,
        block=F.lit("i94cntyl"),
        code=F.col("n_nationkey"),
        label=F.col("n_name"),
        order=[F.col("n_nationkey")],
        path=scratch_path(spark, "nation-labels"),
    )
    return build_origin(spark, path)


def states_build(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    raw = n.select(
        F.col("n_name").alias("State"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("Abbreviation"),
    )
    path = write_csv(raw.unionByName(raw), scratch_path(spark, "states-csv"))
    return build_states(spark, path)


# --- the star built by the library's own builders ------------------------------

MISSING_SEGMENT = "MACHINERY"  # its arrivals have no state entry (like GU or 99)


def _capitalized(c):
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def _star_labels(spark: SparkSession, d: str) -> str:
    """Country code list derived from nation (code = nation key, label = name)."""
    return write_label_file(
        table(spark, d, "nation"),
        block=F.lit("i94cntyl"),
        code=F.col("n_nationkey"),
        label=F.col("n_name"),
        order=[F.col("n_nationkey")],
        path=scratch_path(spark, "star-labels"),
    )


def _star_states(spark: SparkSession, d: str) -> str:
    """States list derived from customer segments (one segment left out)."""
    segments = table(spark, d, "customer").select(
        _capitalized(F.col("c_mktsegment")).alias("State"), F.col("c_mktsegment").alias("Abbreviation")
    ).where(F.col("Abbreviation") != MISSING_SEGMENT)
    return write_csv(segments, scratch_path(spark, "star-states"))


def _star_rates(spark: SparkSession, d: str) -> str:
    """Rate sheet derived from orders and their customers' segments."""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    sheet = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        F.year("o_orderdate").cast("string").alias("Year"),
        F.date_format("o_orderdate", "MMMM").alias("Month"),
        _capitalized(F.coalesce("c_mktsegment", F.lit("none"))).alias("State"),
        F.col("o_orderpriority").alias("County"),
        F.round(F.col("o_totalprice") / 10000, 1).cast("string").alias("Rate"),
    )
    return write_csv(sheet, scratch_path(spark, "star-rates"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A dimension written once, as a published one is: sizing and joining it reads
    its files and does not build it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def analyst_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The analyst example on the built star: origin in two roles, states, birth filter."""
    fact = build_fact(raw_arrivals(spark, d))
    origin = _stored(build_origin(spark, _star_labels(spark, d)), "star-origin")
    states = _stored(build_states(spark, _star_states(spark, d)), "star-dim-states")
    return arrivals_lookup(fact, origin, states, LOOKUP_NATION)


def analyst_lookup_top10(spark: SparkSession, d: str) -> DataFrame:
    return top_n(analyst_lookup(spark, d), 10, [F.col("immigration_id").asc()])


def star_arrivals_vs_rate(spark: SparkSession, d: str) -> DataFrame:
    """Arrivals per state and month beside that state's average rate, on the built star."""
    fact = build_fact(raw_arrivals(spark, d))
    states = build_states(spark, _star_states(spark, d))
    marts = mart_arrivals_vs_rate(fact, states, build_unemployment(spark, _star_rates(spark, d)))
    return marts.withColumn("avg_rate", _rounded("avg_rate"))


def star_load(spark: SparkSession, d: str) -> DataFrame:
    """Both stages on raw inputs derived from the tables, then the published tables' key profile."""
    root = scratch_path(spark, "star-load")
    raw_arrivals(spark, d).write.parquet(f"{root}/raw_fact")
    run = build_star_files(
        spark,
        f"{root}/raw_fact",
        _star_labels(spark, d),
        _star_states(spark, d),
        _star_rates(spark, d),
        f"{root}/run1",
    )
    store = TableStore(spark, f"{root}/published")
    load_star_files(spark, store, run.files)
    state, out = store.state(), None
    for spec in REGISTRY.values():
        current = store.current(spec, state=state)
        prof = key_profile(current, spec.keys).select(
            F.lit(spec.name).alias("table_name"), "rows", "null_key_rows", "duplicate_keys"
        )
        out = prof if out is None else out.unionByName(prof)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fact_scan_project": fact_scan_project,
    "epoch_day_to_date": epoch_day_to_date_q,
    "compact_date_ymd": compact_date_ymd,
    "compact_date_mdy": compact_date_mdy,
    "month_name_to_number": month_name_to_number_q,
    "cast_columns": cast_columns_q,
    "rename_columns": rename_columns_q,
    "csv_scan_typed": csv_scan_typed,
    "label_blocks": label_blocks_q,
    "label_last_wins": label_last_wins,
    "distinct_rows": distinct_rows_q,
    "rate_rollup": rate_rollup,
    "insert_only_fact": insert_only_fact,
    "scd1_single_key": scd1_single_key,
    "scd1_composite_key": scd1_composite_key,
    "role_playing_lookup": role_playing_lookup,
    "state_lookup": state_lookup,
    "lookup_top10": lookup_top10,
    "arrivals_vs_rate": arrivals_vs_rate,
    "dq_null_keys": dq_null_keys,
    "dq_null_key_sample": dq_null_key_sample,
    "dq_duplicate_keys": dq_duplicate_keys,
    "row_counts": row_counts_q,
    "write_roundtrip": write_roundtrip,
    "dq_report": dq_report,
    "staging_load": staging_load,
    "fact_build": fact_build,
    "origin_build": origin_build,
    "states_build": states_build,
    "load_all": load_all,
    "analyst_lookup": analyst_lookup,
    "analyst_lookup_top10": analyst_lookup_top10,
    "star_arrivals_vs_rate": star_arrivals_vs_rate,
    "star_load": star_load,
    **STORE_QUERIES,
}
