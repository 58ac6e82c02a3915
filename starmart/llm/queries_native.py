"""Registered queries of the DataFrame-only operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .line_dedup import dedup_lines
from .mixing import BLOCKS, FINE, FINE_BITS, GOLDEN, RANGE, SHARE, mix
from .secrets import find_secrets, span_text
from .url_filter import url_verdicts

# The rules of the URL query (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = """
WITH rules(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts AS (
  SELECT page_id, row_number() OVER () AS n,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
hits AS (
  SELECT n, rh || rp AS rule, rv,
         row_number() OVER (PARTITION BY n ORDER BY length(rh || rp) DESC, length(rh) DESC, rv DESC) AS best
  FROM parts JOIN rules ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM hits WHERE best = 1) USING (n)
"""


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS ord, row_number() OVER () AS n FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS sid FROM s0),
s2 AS (SELECT *, [5, 2, 1][((sid - 1) % 3 + 1)::INT]::BIGINT AS weight, source_size * 3 AS cap,
              sum(source_size) OVER ()::BIGINT AS all_size FROM s1),
s3 AS (SELECT *, all_size - coalesce(sum(cap) OVER w, 0)::BIGINT AS left_size,
              sum(weight) OVER ()::BIGINT - coalesce(sum(weight) OVER w, 0)::BIGINT AS left_weight
       FROM s2 WINDOW w AS (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, cap * left_weight <= weight * left_size AS capped FROM s3),
s5 AS (SELECT *, CASE WHEN capped THEN cap::DOUBLE ELSE weight::DOUBLE
              * (all_size - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::BIGINT::DOUBLE
              / greatest(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 1)::BIGINT::DOUBLE END AS target FROM s4),
s6 AS (SELECT sid, source, source_size, target, greatest((source_size + {BLOCKS - 1}) // {BLOCKS}, 1) AS block FROM s5),
s7 AS (SELECT *, (source_size + block - 1) // block AS blocks FROM s6),
s8 AS (SELECT *, floor(target / greatest(source_size, 1)::DOUBLE * blocks::DOUBLE * {SHARE})::BIGINT AS share FROM s7),
s9 AS (SELECT *, sum(share) OVER (ORDER BY sid)::HUGEINT AS upto, greatest(sum(share) OVER (), 1)::HUGEINT AS total FROM s8),
bounds AS (SELECT *, (upto - share) * {RANGE << FINE_BITS} // total AS lo, upto * {RANGE << FINE_BITS} // total AS hi FROM s9),
points AS (SELECT i, ((i * {GOLDEN}) % {RANGE}) * {1 << FINE_BITS} + {(1 << FINE_BITS) - 1} - ((i // {RANGE}) * {FINE}) % {1 << FINE_BITS} AS x
           FROM (SELECT unnest(range(0, ((max(total) + {SHARE // 2}) // {SHARE})::BIGINT)) AS i FROM s9 WHERE upto > 0)),
ranked AS (SELECT sid, blocks, row_number() OVER (PARTITION BY sid ORDER BY i) - 1 AS rank FROM points JOIN bounds ON x >= lo AND x < hi),
uses AS (SELECT sid, rank % blocks AS k, count(*) AS uses FROM ranked WHERE rank < 3 * blocks GROUP BY ALL),
docs AS (SELECT d.n, d.doc_id, d.size, sid, source_size, target, block,
                coalesce(sum(d.size) OVER (PARTITION BY sid ORDER BY ord, d.doc_id, d.size, d.n
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
         FROM sized d JOIN bounds b ON d.source IS NOT DISTINCT FROM b.source),
spread AS (SELECT n, sid, size, block, start, unnest(range(start // block, (start + size - 1) // block + 1)) AS k FROM docs WHERE size > 0),
got AS (SELECT n, sum(uses * (least(start + size, (k + 1) * block) - greatest(start, k * block)))::BIGINT AS taken
        FROM spread JOIN uses USING (sid, k) GROUP BY n)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM docs LEFT JOIN got USING (n)
"""


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["k"] == kind)).cast("long")

    base = F.filter("spans", lambda x: x["k"] < 3)
    counts = [count(k).alias(name) for k, name in enumerate(("n_assign", "n_access", "n_hex"))]
    return find_secrets(docs).select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def _kind_sql(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
  SELECT n, {order} AS k, '{kind}' AS kind, s, s + len(m[i]) AS e FROM (
    SELECT n, i, m, g, list_sum([len(x) FOR x IN gaps[1:i]])::BIGINT + coalesce(list_sum([len(x) FOR x IN m[1:i - 1]]), 0)::BIGINT AS s
    FROM (SELECT n, unnest(range(1, len(m) + 1)) AS i, m, g, gaps FROM (
      SELECT n, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {group}) AS g,
             string_split_regex(t, '{p}') AS gaps FROM docs WHERE regexp_matches(t, '{p}'))))
  WHERE len(g[i]) >= {least}"""


def _op5_sql() -> str:
    from .secrets import RULES

    kinds = "\n  UNION ALL".join(_kind_sql(k, r.kind, r.pattern, r.group, r.least) for k, r in enumerate(RULES))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
spans AS ({kinds}),
told AS (
  SELECT n, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY n)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (n)
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP10_SQL = """
WITH lined AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS l, row_number() OVER () AS n,
         ('0x' || left(md5(coalesce(text, '')), 15))::BIGINT AS body FROM documents),
wins AS (
  SELECT n, doc_id, body, i, [l[i], l[i + 1], l[i + 2]] AS w
  FROM (SELECT n, doc_id, body, l, unnest(range(1, len(l) - 1)) AS i FROM lined)),
later AS (
  SELECT n, i FROM (SELECT n, i, rank() OVER (PARTITION BY w ORDER BY doc_id NULLS LAST, body, i) AS occ FROM wins) WHERE occ > 1),
gone AS (SELECT DISTINCT n, i + k AS i FROM later, (VALUES (0), (1), (2)) AS o(k)),
kept AS (
  SELECT n, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n_kept
  FROM (SELECT n, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM lined) ANTI JOIN gone USING (n, i) GROUP BY n)
SELECT doc_id, len(l)::BIGINT AS n_lines, (len(l) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM lined LEFT JOIN kept USING (n)
"""

QUERIES = {"op3_url_filter": op3_url_filter, "op4_mixing": op4_mixing, "op5_secrets": op5_secrets, "op10_line_dedup": op10_line_dedup}
ORACLE_SQL = {"op3_url_filter": OP3_SQL, "op4_mixing": OP4_SQL, "op5_secrets": _op5_sql(), "op10_line_dedup": OP10_SQL}
