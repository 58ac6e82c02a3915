"""Registered queries of fingerprints, quality and language.

Their results cannot be said in SQL; tests hold them against plain versions and
held-out accuracy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, langid, quality
from .common import table


def fold(n: int) -> Column:
    """crc32 of the doc_id's text, modulo n; null doc_ids hash the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    positives = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & (fold(4) != 2))
    model = quality.train(docs, positives, fold(4) != 2)
    scored = quality.score(docs.withColumn("held_out", fold(4) == 2), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(fold(3) != 1).select("text", "lang"))
    labelled = langid.label_languages(docs.select("doc_id", "text", (fold(3) == 1).alias("held_out")), model)
    return labelled.select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op1_fingerprints": op1_fingerprints, "op2_quality": op2_quality, "op9_language": op9_language}
