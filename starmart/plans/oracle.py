"""Oracle SQL for the query contract (DuckDB dialect, tables pre-registered).

Each statement computes the same result as the Spark query of the same name,
written independently from the table definitions. Averages are plain averages,
rounded on both sides; DuckDB date parts are cast to
INTEGER to match Spark.
"""

from __future__ import annotations

_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders
"""

_RAW_ARRIVALS = """
SELECT
  CAST(o.o_orderkey AS DOUBLE) AS cicid,
  CAST(c.c_nationkey AS DOUBLE) AS i94cit,
  CAST((c.c_nationkey + 1) % 25 AS DOUBLE) AS i94res,
  o.o_orderpriority AS i94port,
  CAST(date_diff('day', DATE '1960-01-01', CAST(o.o_orderdate AS DATE)) AS DOUBLE) AS arrdate,
  CAST(o.o_orderkey % 4 AS DOUBLE) AS i94mode,
  c.c_mktsegment AS i94addr,
  CASE WHEN o.o_orderkey % 11 <> 0
       THEN CAST(date_diff('day', DATE '1960-01-01', CAST(o.o_orderdate AS DATE)) + 14 AS DOUBLE)
  END AS depdate,
  CAST(c.c_custkey % 90 AS DOUBLE) AS i94bir,
  CAST(o.o_orderkey % 3 + 1 AS DOUBLE) AS i94visa,
  strftime(CAST(o.o_orderdate AS DATE), '%Y%m%d') AS dtadfile,
  o.o_orderstatus AS visapost,
  CAST(year(o.o_orderdate) - c.c_custkey % 90 AS DOUBLE) AS biryear,
  CASE WHEN o.o_orderkey % 10 = 0 THEN 'D/S'
       ELSE strftime(CAST(o.o_orderdate AS DATE) + 180, '%m%d%Y') END AS dtaddto,
  CASE WHEN o.o_custkey % 3 = 0 THEN 'M' WHEN o.o_custkey % 3 = 1 THEN 'F' END AS gender,
  c.c_name AS airline,
  CAST(o.o_custkey AS VARCHAR) AS fltno,
  CAST(o.o_orderkey + 5000000000 AS DOUBLE) AS admnum
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

FACT_SQL = f"""
SELECT
  TRY_CAST(trunc(cicid) AS BIGINT) AS immigration_id,
  TRY_CAST(trunc(i94cit) AS INTEGER) AS country_of_birth,
  TRY_CAST(trunc(i94res) AS INTEGER) AS country_of_residence,
  i94port AS arrival_port,
  DATE '1960-01-01' + TRY_CAST(trunc(arrdate) AS INTEGER) AS arrival_date,
  TRY_CAST(trunc(i94mode) AS INTEGER) AS arrival_mode,
  i94addr AS address_state_code,
  DATE '1960-01-01' + TRY_CAST(trunc(depdate) AS INTEGER) AS departure_date,
  TRY_CAST(trunc(i94bir) AS INTEGER) AS respondent_age,
  TRY_CAST(trunc(i94visa) AS INTEGER) AS visa_category,
  CAST(try_strptime(dtadfile, '%Y%m%d') AS DATE) AS date_file,
  visapost AS visa_issue_authority,
  TRY_CAST(trunc(biryear) AS INTEGER) AS year_of_birth,
  CAST(try_strptime(dtaddto, '%m%d%Y') AS DATE) AS permitted_to_stay_until,
  gender,
  airline AS arrival_airline,
  TRY_CAST(trunc(admnum) AS BIGINT) AS admission_number,
  fltno AS flight_number
FROM ({_RAW_ARRIVALS}) raw
"""

_ORDERS_SPLIT = f"""
WITH o AS ({_ORDERS}),
t AS (SELECT * FROM o WHERE o_orderdate < DATE '1999-01-01'),
b AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderdate < DATE '1999-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM o WHERE coalesce(o_orderdate >= DATE '1998-07-01', true)
),
s AS (SELECT * FROM b UNION ALL SELECT * FROM b),
ins AS (
  SELECT DISTINCT * FROM s
  WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)
)
"""

_CUSTOMER_SPLIT = """
WITH t AS (SELECT * FROM customer WHERE c_acctbal < 6000.0),
b AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment
  FROM customer WHERE coalesce(c_acctbal >= 3000.0, true)
),
s AS (SELECT * FROM b UNION ALL SELECT * FROM b),
ds AS (SELECT DISTINCT * FROM s),
kept AS (
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM ds WHERE ds.c_custkey = t.c_custkey)
)
"""

_LINEITEM_SPLIT = """
WITH li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
  FROM lineitem
),
t AS (SELECT * FROM li WHERE l_shipdate < DATE '1999-01-01'),
b AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM li WHERE coalesce(l_shipdate >= DATE '1998-07-01', true)
),
s AS (SELECT * FROM b UNION ALL SELECT * FROM b),
ds AS (SELECT DISTINCT * FROM s),
kept AS (
  SELECT * FROM t WHERE NOT EXISTS (
    SELECT 1 FROM ds WHERE ds.l_orderkey = t.l_orderkey AND ds.l_linenumber = t.l_linenumber)
)
"""


def _profile(table: str, keys: list[str]) -> str:
    any_null = " OR ".join(f"{k} IS NULL" for k in keys)
    cols = ", ".join(keys)
    return f"""
SELECT '{table}' AS table_name, 'null_keys' AS rule,
       CAST(COALESCE(SUM(n) FILTER (WHERE {any_null}), 0) AS BIGINT) AS failures
FROM (SELECT {cols}, COUNT(*) AS n FROM {table} GROUP BY {cols}) g
UNION ALL
SELECT '{table}' AS table_name, 'duplicate_keys' AS rule,
       COUNT(*) FILTER (WHERE NOT ({any_null}) AND n > 1) AS failures
FROM (SELECT {cols}, COUNT(*) AS n FROM {table} GROUP BY {cols}) g
"""


_REPORTED = {
    "orders": ["o_orderkey"],
    "customer": ["c_custkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "nation": ["n_nationkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
}

_COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _cap(c: str) -> str:
    return f"upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


_STAR = f"""
WITH f AS ({FACT_SQL}),
origin AS (SELECT n_nationkey AS country_code, n_name AS country_name FROM nation),
states AS (
  SELECT DISTINCT {_cap('c_mktsegment')} AS state_name, c_mktsegment AS abbreviation
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
),
unemployment AS (
  SELECT year, month, state,
         ROUND(AVG(rate) + 1e-8, 6) AS avg_rate
  FROM (
    SELECT DISTINCT CAST(year(o.o_orderdate) AS INTEGER) AS year,
           CAST(month(o.o_orderdate) AS INTEGER) AS month,
           {_cap("coalesce(c.c_mktsegment, 'none')")} AS state, o.o_orderpriority AS county,
           round(o.o_totalprice / 10000, 1) AS rate
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  ) d
  GROUP BY year, month, state
),
lookup AS (
  SELECT f.immigration_id, b.country_name AS country_of_birth,
         r.country_name AS country_of_residence, s.state_name,
         f.arrival_date, f.date_file, f.permitted_to_stay_until
  FROM f
  LEFT JOIN origin b ON f.country_of_birth = b.country_code
  LEFT JOIN origin r ON f.country_of_residence = r.country_code
  LEFT JOIN states s ON s.abbreviation = f.address_state_code
  WHERE b.country_name = 'NATION_7'
)
"""


ORACLE_SQL: dict[str, str] = {
    "fact_scan_project": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders
""",
    "epoch_day_to_date": """
SELECT o_orderkey, day_number,
       DATE '1960-01-01' + CAST(trunc(day_number) AS INTEGER) AS arrival_date
FROM (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 11 <> 0 THEN
           CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)
           + CAST(o_orderkey % 4 AS DOUBLE) * 0.25
         END AS day_number
  FROM orders
) r
""",
    "compact_date_ymd": """
SELECT o_orderkey, date_file_text,
       CAST(try_strptime(date_file_text, '%Y%m%d') AS DATE) AS date_file
FROM (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y%m%d') END
           AS date_file_text
  FROM orders
) r
""",
    "compact_date_mdy": """
SELECT o_orderkey, stay_text,
       CAST(try_strptime(stay_text, '%m%d%Y') AS DATE) AS permitted_to_stay_until
FROM (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 10 = 0 THEN 'D/S'
              ELSE strftime(CAST(o_orderdate AS DATE) + 180, '%m%d%Y') END AS stay_text
  FROM orders
) r
""",
    "month_name_to_number": """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 17 = 0 THEN monthname(o_orderdate) || 'x'
            WHEN o_orderkey % 3 = 0 THEN upper(monthname(o_orderdate))
            ELSE monthname(o_orderdate) END AS month_name,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE CAST(month(o_orderdate) AS INTEGER) END AS month
FROM orders
""",
    "cast_columns": """
SELECT o_orderkey,
       TRY_CAST(trunc(CAST(o_orderkey AS DOUBLE) + 0.75) AS INTEGER) AS key_fraction,
       TRY_CAST(trunc(-o_totalprice) AS INTEGER) AS negative_price,
       TRY_CAST(o_orderkey + 5000000000 AS BIGINT) AS admission,
       TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END
                AS INTEGER) AS code_text,
       TRY_CAST(o_orderkey + 5000000000 AS INTEGER) AS admission_as_int
FROM orders
""",
    "rename_columns": """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_code,
       c_acctbal, c_mktsegment AS segment
FROM customer
""",
    "csv_scan_typed": """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""",
    "label_blocks": """
SELECT lower(replace(p_brand, '#', '')) AS block, CAST(p_partkey AS VARCHAR) AS code,
       trim(p_name) AS label
FROM part
""",
    "label_last_wins": """
SELECT 'nation_customer' AS block, CAST(c_nationkey AS VARCHAR) AS code,
       arg_max(c_name, c_custkey) AS label
FROM customer GROUP BY c_nationkey
""",
    "distinct_rows": """
SELECT DISTINCT * FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer) u
""",
    "rate_rollup": """
SELECT year, month, state,
       ROUND(AVG(rate) + 1e-8, 6) AS avg_rate
FROM (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month,
         o_orderpriority AS state, CAST(o_custkey AS VARCHAR) AS county, o_totalprice AS rate
  FROM orders
) d
GROUP BY year, month, state
""",
    "insert_only_fact": _ORDERS_SPLIT + """
SELECT * FROM t UNION ALL SELECT * FROM ins
""",
    "scd1_single_key": _CUSTOMER_SPLIT + """
SELECT * FROM kept UNION ALL SELECT * FROM ds
""",
    "scd1_composite_key": _LINEITEM_SPLIT + """
SELECT * FROM kept UNION ALL SELECT * FROM ds
""",
    "load_all": f"""
SELECT * FROM (
{_ORDERS_SPLIT}
SELECT 'orders' AS table_name, (SELECT COUNT(*) FROM t) AS rows_before,
       (SELECT COUNT(*) FROM ins) AS inserted, CAST(0 AS BIGINT) AS replaced,
       (SELECT COUNT(*) FROM t) + (SELECT COUNT(*) FROM ins) AS rows_after
) x1
UNION ALL
SELECT * FROM (
{_CUSTOMER_SPLIT}
SELECT 'customer' AS table_name, (SELECT COUNT(*) FROM t) AS rows_before,
       (SELECT COUNT(*) FROM ds) AS inserted,
       (SELECT COUNT(*) FROM t) - (SELECT COUNT(*) FROM kept) AS replaced,
       (SELECT COUNT(*) FROM kept) + (SELECT COUNT(*) FROM ds) AS rows_after
) x2
UNION ALL
SELECT * FROM (
{_LINEITEM_SPLIT}
SELECT 'lineitem' AS table_name, (SELECT COUNT(*) FROM t) AS rows_before,
       (SELECT COUNT(*) FROM ds) AS inserted,
       (SELECT COUNT(*) FROM t) - (SELECT COUNT(*) FROM kept) AS replaced,
       (SELECT COUNT(*) FROM kept) + (SELECT COUNT(*) FROM ds) AS rows_after
) x3
""",
    "role_playing_lookup": """
SELECT l.l_orderkey, l.l_linenumber, CAST(o.o_orderdate AS DATE) AS o_orderdate,
       cn.n_name AS customer_nation, sn.n_name AS supplier_nation, l.l_extendedprice
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
WHERE cn.n_name = 'NATION_7'
""",
    "state_lookup": """
SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_name AS state_name
FROM customer c
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) n ON c.c_nationkey = n.n_nationkey
""",
    "lookup_top10": """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders ORDER BY o_orderdate DESC, o_orderkey ASC LIMIT 10
""",
    "arrivals_vs_rate": """
SELECT a.year, a.month, a.arrivals, r.avg_rate
FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         COUNT(*) AS arrivals
  FROM orders GROUP BY 1, 2
) a
LEFT JOIN (
  SELECT CAST(month(ts) AS INTEGER) AS month,
         ROUND(AVG(value) + 1e-8, 6) AS avg_rate
  FROM events GROUP BY 1
) r ON a.month = r.month
""",
    "dq_null_keys": """
SELECT 'orders' AS table_name, COUNT(*) FILTER (WHERE k IS NULL OR c IS NULL) AS null_key_rows,
       COUNT(*) FILTER (WHERE k IS NULL OR c IS NULL) = 0 AS passed
FROM (
  SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS k,
         CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END AS c
  FROM orders
) r
""",
    "dq_null_key_sample": """
SELECT k AS o_orderkey, c AS o_custkey, o_totalprice
FROM (
  SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS k,
         CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END AS c, o_totalprice
  FROM orders
) r
WHERE k IS NULL OR c IS NULL
ORDER BY k NULLS FIRST, c NULLS FIRST, o_totalprice NULLS FIRST LIMIT 1
""",
    "dq_duplicate_keys": """
SELECT 'lineitem' AS table_name, CAST(SUM(n) AS BIGINT) AS rows,
       COUNT(*) AS distinct_keys,
       COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys,
       CAST(COALESCE(SUM(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows,
       COUNT(*) FILTER (WHERE n > 1) = 0 AS passed
FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) g
""",
    "row_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}" for t in _COUNTED
    ),
    "write_roundtrip": """
SELECT 'orders' AS table_name, COUNT(*) AS written_rows, COUNT(*) AS read_rows,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS read_price,
       CAST(SUM(o_orderkey * (year(o_orderdate) * 12 + month(o_orderdate))) AS BIGINT) AS read_months, TRUE AS passed
FROM orders
""",
    "dq_report": "\nUNION ALL\n".join(
        f"SELECT *, failures = 0 AS passed FROM ({_profile(t, k)}) p{i}"
        for i, (t, k) in enumerate(_REPORTED.items())
    ),
    "staging_load": FACT_SQL,
    "fact_build": FACT_SQL,
    "origin_build": """
SELECT n_nationkey AS country_code, n_name AS country_name FROM nation
""",
    "states_build": """
SELECT DISTINCT n_name AS state_name, 'N' || CAST(n_nationkey AS VARCHAR) AS abbreviation
FROM nation
""",
    "analyst_lookup": _STAR + "SELECT * FROM lookup",
    "analyst_lookup_top10": _STAR + "SELECT * FROM lookup ORDER BY immigration_id LIMIT 10",
    "star_arrivals_vs_rate": _STAR + """
SELECT a.year, a.month, a.abbreviation, s.state_name, a.arrivals, u.avg_rate
FROM (
  SELECT CAST(year(arrival_date) AS INTEGER) AS year, CAST(month(arrival_date) AS INTEGER) AS month,
         address_state_code AS abbreviation, COUNT(*) AS arrivals
  FROM f GROUP BY 1, 2, 3
) a
LEFT JOIN states s ON a.abbreviation = s.abbreviation
LEFT JOIN unemployment u ON u.year = a.year AND u.month = a.month AND u.state = s.state_name
""",
    "star_load": _STAR + """
SELECT 'fact_immigration' AS table_name, COUNT(*) AS rows,
       COUNT(*) FILTER (WHERE immigration_id IS NULL) AS null_key_rows,
       COUNT(*) - COUNT(DISTINCT immigration_id) AS duplicate_keys
FROM f
UNION ALL
SELECT 'dimension_states', COUNT(*), COUNT(*) FILTER (WHERE state_name IS NULL), COUNT(state_name) - COUNT(DISTINCT state_name) FROM states
UNION ALL
SELECT 'dimension_origin', COUNT(*), COUNT(*) FILTER (WHERE country_code IS NULL), COUNT(country_code) - COUNT(DISTINCT country_code) FROM origin
UNION ALL
SELECT 'dimension_unemployment', COUNT(*), COUNT(*) FILTER (WHERE year IS NULL OR month IS NULL OR state IS NULL),
       COUNT(*) FILTER (WHERE year IS NOT NULL AND month IS NOT NULL AND state IS NOT NULL)
       - COUNT(DISTINCT CASE WHEN year IS NOT NULL AND month IS NOT NULL AND state IS NOT NULL THEN (year, month, state) END) FROM unemployment
""",
}
