"""Distinct rows and grouped roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Planned as partial + final hash aggregates, so
    duplicates collapse map-side before the shuffle."""
    return df.dropDuplicates()


def last_value(df: DataFrame, keys: Sequence[str], value: str, order: Column) -> DataFrame:
    """One row per key: ``value`` of the row with the greatest ``order``."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def grouped_average(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Average of ``value`` per key, unweighted over input rows, nulls skipped.

    The plain average: no digit of a value is cut, NaN and infinities show in
    their group's average, and an all-null group gives null. The last bits of a
    double sum can follow the order of tasks; reports round the result.
    Planned as partial + final aggregates: a hot key collapses map-side.
    """
    return df.groupBy(*keys).agg(F.avg(value).alias(alias))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n): one column-less count scan per table, unioned."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out
