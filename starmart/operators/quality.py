"""Key checks, read-back counts and the check report.

Null and duplicate keys are found by one grouped aggregate per table: rows are
counted per key with a partial (map-side) aggregate, so a key shared by a
third of the table still leaves each task as one row, and a second, global
aggregate over the per-key counts yields every figure at once. Composite keys
are grouped on their columns, so null parts and separator collisions cannot
hide a duplicate. Null and duplicate keys are reported apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PROFILE_COLUMNS = ["rows", "null_key_rows", "distinct_keys", "duplicate_keys", "duplicate_rows"]


def _any_null(keys: Sequence[str]):
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, null_key_rows, distinct_keys, duplicate_keys, duplicate_rows.

    ``distinct_keys``/``duplicate_*`` count only keys without null parts;
    ``duplicate_rows`` is the number of rows beyond the first of each key.
    """
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    has_null = _any_null(keys)
    dup = ~has_null & (F.col("_n") > 1)
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("_n"), zero).alias("rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("_n"))), zero).alias("null_key_rows"),
        F.count_if(~has_null).alias("distinct_keys"),
        F.count_if(dup).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(dup, F.col("_n") - 1)), zero).alias("duplicate_rows"),
    )


def null_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: null_key_rows (rows where any key column is null). One scan, no shuffle."""
    return df.agg(F.count_if(_any_null(list(keys))).alias("null_key_rows"))


def null_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows in which any key column is null."""
    return df.where(_any_null(list(keys)))


def null_key_sample(df: DataFrame, keys: Sequence[str]) -> list:
    """At most one offending row, for an error message."""
    return null_key_rows(df, keys).limit(1).collect()


def duplicate_offenders(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (without null parts) held by more than one row, with their row count."""
    keys = list(keys)
    return (
        df.where(~_any_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def report_rows(table_name: str, profile: DataFrame) -> DataFrame:
    """Check-report rows (table_name, rule, failures, passed) from a key profile.

    Both rules come out of the one profile row (an inline explode), so the
    table's grouped aggregate runs once.
    """
    rules = F.inline(
        F.array(
            F.struct(F.lit("null_keys").alias("rule"), F.col("null_key_rows").alias("failures")),
            F.struct(F.lit("duplicate_keys").alias("rule"), F.col("duplicate_keys").alias("failures")),
        )
    )
    return profile.select(F.lit(table_name).alias("table_name"), rules).withColumn(
        "passed", F.col("failures") == 0
    )


def check_report(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Report over several tables: one grouped aggregate per table, then a union."""
    out = None
    for name, (df, keys) in tables.items():
        rows = report_rows(name, key_profile(df, keys))
        out = rows if out is None else out.unionByName(rows)
    return out


@dataclass
class WriteCheck:
    table_name: str
    written_rows: int
    read_rows: int

    @property
    def passed(self) -> bool:
        return self.written_rows == self.read_rows


def write_parquet_observed(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    extra_metrics: Sequence = (),
    mode: str = "errorifexists",
    drop_after: Sequence[str] = (),
) -> dict:
    """Write ``df`` as Parquet and return metrics observed during that same job.

    The row count (and any reject counts) ride along with the write, so the
    written frame is never evaluated a second time. ``drop_after`` names
    columns that feed the metrics but are not written.
    """
    obs = Observation(f"write-{abs(hash(path))}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra_metrics)
    if drop_after:
        observed = observed.drop(*drop_after)
    writer = observed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return dict(obs.get)


def content_checksum(columns: Sequence[str]) -> Column:
    """Aggregate ``content``: a checksum of a bag of rows that no order and no
    partitioning changes (the exact sum of row hashes). A changed, lost or repeated
    row changes it."""
    return F.sum(F.xxhash64(*columns).cast("decimal(28,0)")).alias("content")


def read_back(
    spark: SparkSession, table_name: str, path: str, written_rows: int, schema: StructType | None = None
) -> WriteCheck:
    """Re-read what was written and compare counts (footer-only count scan). A
    partitioned write of no rows leaves no file to infer from: pass its schema."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return WriteCheck(table_name, written_rows, reader.parquet(path).count())
