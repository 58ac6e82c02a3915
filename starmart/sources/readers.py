"""Typed readers for the raw files (Parquet and CSV with a header)."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """Parquet directory (or several) as one DataFrame.

    With a schema no footer sampling is needed at planning time; a declared
    column that a file lacks reads as null. Only the columns a query uses are read.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def header_groups(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Files of ``paths`` by their header line (the first line that is not blank).

    One job that reads the first split of each file as text; one row per file
    reaches the driver, which lists the files of a read anyway.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    first = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    out: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():
        out.setdefault(r.header.lstrip("\ufeff"), []).append(unquote(r.file))  # the path comes as a URL
    return out


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """CSV with a header row, quotes honoured, every value read as text.

    Columns are matched to ``schema`` by header name, case-insensitively, file by file:
    files are grouped by their header, each group is one scan, and the groups are
    united by name. A declared column missing from a header raises. Declared columns
    come first under their declared names, other header columns follow (they still take
    part in whole-row de-duplication; a file without one reads null there). Files that are
    empty hold no rows. Values stay text and are typed afterwards with
    null-on-failure conversions.
    """
    paths = [path] if isinstance(path, str) else list(path)
    groups = header_groups(spark, paths)
    if len(groups) <= 1:
        return _read_group(spark, paths, schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [_read_group(spark, files, schema) for files in groups.values()])


def _read_group(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """Files that share one header."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False).csv(paths)
    by_lower = {c.lower(): c for c in raw.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in by_lower]
    if missing:
        raise ValueError(f"{paths}: header lacks {missing}")
    declared = [F.col(f"`{by_lower[f.name.lower()]}`").alias(f.name) for f in schema.fields]
    used = {f.name.lower() for f in schema.fields}
    extra = [F.col(f"`{c}`") for c in raw.columns if c.lower() not in used]
    return raw.select(*declared, *extra)
