"""Registered queries of near duplicates, decontamination and repeated passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import find_leaks
from .jaccard import jaccard_components
from .passages import remove_repeats


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs, n=4, num=85, den=100).drop("body", "component")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


OP8_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
wins AS (SELECT n, place, i, array_to_string(w[i:i + 12], ' ') AS t FROM (SELECT n, place, w, unnest(range(1, len(w) - 11)) AS i FROM docs)),
least AS (SELECT t, min(place) AS first FROM wins GROUP BY t),
gone AS (SELECT DISTINCT n, i + k AS i FROM wins JOIN least USING (t), (SELECT unnest(range(0, 13)) AS k) WHERE first < place),
kept AS (SELECT n, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n_kept
         FROM (SELECT n, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs) ANTI JOIN gone USING (n, i) GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (n)
"""

QUERIES = {"op6_ngram_jaccard": op6_ngram_jaccard, "op7_decontamination": op7_decontamination, "op8_substring_dedup": op8_substring_dedup}
ORACLE_SQL = {"op8_substring_dedup": OP8_SQL}
