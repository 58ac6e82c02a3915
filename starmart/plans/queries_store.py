"""Queries of the published store on the driver's test tables, and their DuckDB SQL.

``star_reload`` runs both stages twice, the second run overlapping the first in
every table, and returns the published content. ``upsert_by_buckets`` and
``fact_compaction`` do the same for one dimension and for many small fact batches.
``mart_maintained`` adds fact batches to the monthly mart, and ``rate_merge`` averages
rates from the stored states of several sheets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from starmart.plans.marts import published_arrivals, stage_arrivals
from starmart.plans.oracle import FACT_SQL, ORACLE_SQL
from starmart.plans.publish import TableStore
from starmart.plans.stages import build_star_files, load_star_files
from starmart.plans.tables import build_fact, merge_rate_states, rate_state, rates_of
from starmart.schemas import FACT, ORIGIN, REGISTRY, STATES, UNEMPLOYMENT_CSV_SCHEMA, TableSpec
from starmart.session import scratch_path
from starmart.sources.derived import rate_sheet, raw_arrivals, table, write_csv, write_label_file
from starmart.sources.readers import read_csv

# Fixed parameters of the two runs (every row of a table is in one run or in both).
FIRST_RUN_END = "1999-01-01"     # run 1 holds arrivals and rates before this date
SECOND_RUN_START = "1998-07-01"  # run 2 those from this date on, or without one
BUCKET_ROWS = 500                # rows of a key bucket in these queries
BATCHES = 3                      # fact batches that are compacted

CUSTOMER = TableSpec(
    "customer",
    StructType(
        [
            StructField("c_custkey", LongType()),
            StructField("c_name", StringType()),
            StructField("c_nationkey", IntegerType()),
            StructField("c_acctbal", DoubleType()),
            StructField("c_mktsegment", StringType()),
        ]
    ),
    ("c_custkey",),
)


def _capitalized(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def _in_run(day: Column, run: int) -> Column:
    if run == 1:
        return day < F.lit(FIRST_RUN_END).cast("date")
    return F.coalesce(day >= F.lit(SECOND_RUN_START).cast("date"), F.lit(True))


def _raw_run(spark: SparkSession, d: str, run: int, root: str) -> list[str]:
    """Raw inputs of a run: arrivals, code list, states, rates. In run 2 values that
    overlap with run 1 differ, so the result tells whose rows were kept."""
    arrivals = raw_arrivals(spark, d)
    arrivals = arrivals.where(_in_run(F.date_add(F.lit("1960-01-01").cast("date"), F.col("arrdate").cast("int")), run))
    if run == 2:
        arrivals = arrivals.withColumn("gender", F.lit("X"))
    arrivals.write.parquet(f"{root}/raw{run}")
    nation = table(spark, d, "nation").where(F.col("n_nationkey") % 5 != 1 if run == 1 else F.col("n_nationkey") % 3 != 0)
    labels = write_label_file(
        nation,
        block=F.lit("i94cntyl"),
        code=F.col("n_nationkey"),
        label=F.col("n_name") if run == 1 else F.concat(F.lit("NEW "), F.col("n_name")),
        order=[F.col("n_nationkey")],
        path=f"{root}/labels{run}",
    )
    customer, segment = table(spark, d, "customer"), F.col("c_mktsegment")
    states = customer.where(segment != ("MACHINERY" if run == 1 else "BUILDING"))
    states = states.select(_capitalized(segment).alias("State"), (segment if run == 1 else F.lower(segment)).alias("Abbreviation"))
    orders = table(spark, d, "orders")
    rates = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").where(_in_run(F.to_date("o_orderdate"), run) & F.col("o_orderdate").isNotNull())
    rates = rates.select(
        F.year("o_orderdate").cast("string").alias("Year"),
        F.date_format("o_orderdate", "MMMM").alias("Month"),
        _capitalized(F.coalesce("c_mktsegment", F.lit("none"))).alias("State"),
        F.col("o_orderpriority").alias("County"),
        F.round(F.col("o_totalprice") / (10000 * run), 1).cast("string").alias("Rate"),
    )
    return [f"{root}/raw{run}", labels, write_csv(states, f"{root}/states{run}"), write_csv(rates, f"{root}/rates{run}")]


def _content(df: DataFrame, name: str) -> DataFrame:
    """(table_name, content): every row as text, averages to six decimals."""

    def cell(field: StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            c = F.round(c + 1e-8, 6).cast("decimal(18,6)")
        return F.coalesce(c.cast("string"), F.lit("~"))

    return df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *(cell(f) for f in df.schema.fields)).alias("content"))


def star_reload(spark: SparkSession, d: str) -> DataFrame:
    """Two overlapping runs into one store; the content of all four published tables.

    Facts of run 1 stay as they are, and run 2 adds only new ids; dimension rows of run
    2 replace those of run 1 with their key, others stay.
    """
    root = scratch_path(spark, "star-reload")
    store = TableStore(spark, f"{root}/published", bucket_rows=BUCKET_ROWS)
    for run in (1, 2):
        files = build_star_files(spark, *_raw_run(spark, d, run, root), f"{root}/run{run}").files
        load_star_files(spark, store, files)
    state = store.state()
    return reduce(DataFrame.unionByName, (_content(store.current(spec, state=state), name) for name, spec in REGISTRY.items()))


def upsert_by_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Customers in key buckets, then two upserts: one of many rows, one of a single key."""
    store = TableStore(spark, scratch_path(spark, "upsert-by-buckets"), bucket_rows=BUCKET_ROWS)
    customer = table(spark, d, "customer")
    last = customer.agg(F.max("c_custkey")).first()[0]
    changed = customer.withColumn("c_mktsegment", F.lower("c_mktsegment"))
    for staging in (
        customer.where("c_acctbal < 6000"),
        changed.where("coalesce(c_acctbal >= 3000, true)"),
        changed.where(F.col("c_custkey") == last).withColumn("c_name", F.lit("last")),
    ):
        staged = store.stage_upsert(CUSTOMER, staging, store.state())
        if staged.problems:
            raise RuntimeError(str(staged.problems))
        store.publish(staged)
    return store.current(CUSTOMER)


def fact_compaction(spark: SparkSession, d: str) -> DataFrame:
    """The fact loaded in batches of ids in no order, packed, and returned whole."""
    store = TableStore(spark, scratch_path(spark, "fact-compaction"))
    fact = build_fact(raw_arrivals(spark, d))
    path = scratch_path(spark, "fact-rows")
    fact.write.parquet(path)
    fact = spark.read.schema(FACT.schema).parquet(path)
    batch = F.pmod(F.xxhash64("immigration_id"), F.lit(BATCHES))
    for k in range(BATCHES):
        # every batch brings the rows of the one before again
        staged = store.stage_insert(FACT, fact.where(batch.isin(k, max(0, k - 1))), store.state())
        store.publish(staged)
    state = store.compact(FACT)
    return store.current(FACT, state=state)


def mart_maintained(spark: SparkSession, d: str) -> DataFrame:
    """The monthly mart after two overlapping fact batches, the second only added to it."""
    store = TableStore(spark, scratch_path(spark, "mart-maintained"), bucket_rows=BUCKET_ROWS)
    for run in (1, 2):
        staged = store.stage_insert(FACT, build_fact(raw_arrivals(spark, d)).where(_in_run(F.col("arrival_date"), run)), store.state())
        store.publish(staged, stage_arrivals(store, staged))
    return published_arrivals(store)


def rate_merge(spark: SparkSession, d: str) -> DataFrame:
    """Averages from the stored states of three rate sheets; the sheets are read once each."""
    sheet, states = rate_sheet(spark, d), []
    for k in range(3):
        mine = sheet.where(F.pmod(F.xxhash64(*sheet.columns), F.lit(3)) == k)
        raw = read_csv(spark, write_csv(mine, scratch_path(spark, "rate-sheet")), UNEMPLOYMENT_CSV_SCHEMA)
        path = scratch_path(spark, "rate-state")
        rate_state(raw).write.parquet(path)
        states.append(spark.read.parquet(path))
    rates = rates_of(merge_rate_states(states))
    return rates.withColumn("avg_rate", F.round(F.col("avg_rate") + 1e-8, 6))


def _text(columns: list[str], table_name: str, source: str) -> str:
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"SELECT '{table_name}' AS table_name, concat_ws('|', {cells}) AS content FROM {source}"


_RATES = """
  SELECT year, month, state, CAST(ROUND(AVG(rate) + 1e-8, 6) AS DECIMAL(18, 6)) AS avg_rate
  FROM (
    SELECT DISTINCT CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month,
           upper(substr(coalesce(c.c_mktsegment, 'none'), 1, 1)) || lower(substr(coalesce(c.c_mktsegment, 'none'), 2)) AS state,
           o.o_orderpriority AS county, round(o.o_totalprice / {scale}, 1) AS rate
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE CAST(o.o_orderdate AS DATE) {which}
  ) d GROUP BY year, month, state"""

_FACT_COLUMNS = FACT.schema.fieldNames()

STORE_ORACLE = {
    "star_reload": f"""
WITH f AS ({FACT_SQL}),
fact AS (
  SELECT * REPLACE (CASE WHEN arrival_date < DATE '{FIRST_RUN_END}' THEN gender ELSE 'X' END AS gender) FROM f),
origin AS (
  SELECT n_nationkey AS country_code, CASE WHEN n_nationkey % 3 <> 0 THEN 'NEW ' || n_name ELSE n_name END AS country_name
  FROM nation WHERE n_nationkey % 3 <> 0 OR n_nationkey % 5 <> 1),
states AS (
  SELECT DISTINCT upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS state_name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment ELSE lower(c_mktsegment) END AS abbreviation
  FROM customer WHERE c_mktsegment IS NOT NULL),
r1 AS ({_RATES.format(scale=10000, which=f"< DATE '{FIRST_RUN_END}'")}),
r2 AS ({_RATES.format(scale=20000, which=f">= DATE '{SECOND_RUN_START}'")}),
rates AS (SELECT * FROM r2 UNION ALL SELECT * FROM r1 ANTI JOIN r2 USING (year, month, state))
{_text(_FACT_COLUMNS, FACT.name, "fact")}
UNION ALL {_text(ORIGIN.schema.fieldNames(), ORIGIN.name, "origin")}
UNION ALL {_text(STATES.schema.fieldNames(), STATES.name, "states")}
UNION ALL {_text(["year", "month", "state", "avg_rate"], "dimension_unemployment", "rates")}
""",
    "upsert_by_buckets": """
SELECT c_custkey, CASE WHEN c_custkey = (SELECT max(c_custkey) FROM customer) THEN 'last' ELSE c_name END AS c_name, c_nationkey, c_acctbal,
       CASE WHEN coalesce(c_acctbal >= 3000, true) OR c_custkey = (SELECT max(c_custkey) FROM customer)
            THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
FROM customer
""",
    "fact_compaction": FACT_SQL,
    "mart_maintained": f"""
SELECT CAST(year(arrival_date) AS INTEGER) AS year, CAST(month(arrival_date) AS INTEGER) AS month,
       address_state_code AS abbreviation, COUNT(*) AS arrivals
FROM ({FACT_SQL}) f GROUP BY ALL
""",
    "rate_merge": ORACLE_SQL["rate_rollup"],
}

STORE_QUERIES = {
    "star_reload": star_reload,
    "upsert_by_buckets": upsert_by_buckets,
    "fact_compaction": fact_compaction,
    "mart_maintained": mart_maintained,
    "rate_merge": rate_merge,
}
