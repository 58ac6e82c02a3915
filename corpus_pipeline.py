"""Corpus pipeline: language, repeated lines, near duplicates, benchmark leaks, mixing.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``. A stage's result is written as Parquet and read again as the next
one's input, so every stage starts from stored rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import join_groups, saved, small, table
from starmart.llm.decontaminate import find_leaks
from starmart.llm.jaccard import jaccard_components
from starmart.llm.langid import label_languages
from starmart.llm.langid import train as train_languages
from starmart.llm.line_dedup import dedup_lines
from starmart.llm.mixing import mix

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Share of a text's letters (times certainty) that its language must reach.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language; a missing ``lang`` takes the identified one.

    Texts that are null, empty or without a letter, and texts in which no
    language holds half of the letters, are rejected.
    """
    docs = docs.select(*COLUMNS)
    model = train_languages(docs.select("text", "lang"))
    labelled = label_languages(docs, model)
    kept = labelled.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line windows. Documents that lose
    every line go; texts without a removed line stay as they are."""
    cut = dedup_lines(docs.select(*COLUMNS)).where("n_removed = 0 or n_removed < n_lines")
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", chars).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word Jaccard 0.8 or more: the one with the
    smallest doc_id (null last), of several such rows the one with the least text
    hash, of equal rows one. Documents without words all stay."""
    docs = docs.select(*COLUMNS)
    found = saved(jaccard_components(docs, n=5, num=4, den=5), "near-duplicates")
    rows = found.groupBy("doc_id", "body", "component").agg(F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("size"), F.first("component_id").alias("component_id"))
    rows = saved(rows.withColumn("named", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near-duplicate-rows")
    # the smallest doc_id names its component; only rows of that doc_id are compared by hash
    heads = rows.where("size > 0 and named").select("doc_id", "body", "component", F.col("n").alias("rows"))
    least = heads.groupBy("component").agg(F.min("body").alias("first"), F.count(F.lit(1)).alias("n"))
    judged = join_groups(heads, least, ["component"]).select("doc_id", "body", F.col("rows").alias("n"), (F.col("body") == F.col("first")).alias("stays"))
    judged = judged.unionByName(rows.where("size > 0 and not named").select("doc_id", "body", "n", F.lit(False).alias("stays")))
    judged = saved(judged.withColumnsRenamed({"doc_id": "_id", "body": "_body"}), "near-duplicate-judged")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_body"))
    out = docs.join(small(judged.where("not stays or n > 1")), same, "left_anti")
    repeated = docs.join(small(judged.where("stays and n > 1")), same, "left_semi")
    return out.unionByName(repeated.withColumn("_body", F.xxhash64("text")).dropDuplicates(["doc_id", "_body"]).drop("_body"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``, even slightly edited."""
    return find_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, sources weighing 5, 2, 1 in turn."""
    return mix(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mixing),
]

#: Language labels, near duplicates and leaks cannot be said in SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on its predecessor's stored rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
