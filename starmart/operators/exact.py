"""Averages of doubles that no order of rows changes, from a state that can be merged.

A double is a whole number times a power of two, so it is cut into three whole
numbers on a fixed grid of 40-bit limbs. Sums of whole numbers are exact in any order,
and sums of two states add up. A state is a table: per key one row per limb in use
(``limb``, ``total``) and rows that count values, infinities and not-a-numbers. Adding up
limbs and dividing takes whole numbers longer than Spark has, so the last step is a
Python function over one short row per key; its result is the double nearest to the
true average.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from fractions import Fraction
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# The last step runs in Python workers, which need pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMB_BITS = 40
# Rows of a state that are not limbs (limbs run from -29 to 25).
COUNT, PLUS_INFINITY, MINUS_INFINITY, NOT_A_NUMBER = 1000, 1001, 1002, 1003


def _pieces(value: Column) -> Column:
    """array<struct<limb:int,part:bigint>> that add up to ``value`` (a finite double)."""
    size, width = F.abs(value), float(1 << LIMB_BITS)
    limb = F.floor(F.log2(size) / LIMB_BITS).cast("int")
    scale = F.pow(F.lit(2.0), limb * (-LIMB_BITS // 2))  # in two steps: each stays in range, so nothing is rounded
    top = size * scale * scale
    high = F.floor(top)
    middle = F.floor((top - high) * width)
    low = F.floor(((top - high) * width - middle) * width)
    sign = F.when(value < 0, -1).otherwise(1)
    return F.array(*(F.struct((limb - k).alias("limb"), (part * sign).cast("long").alias("part")) for k, part in enumerate((high, middle, low))))


def average_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, limb, total: the state of the average of ``value`` per key. Nulls are
    skipped; a key with nulls only keeps its count row. Partial sums are made in the map
    tasks, so a hot key leaves each task as a few rows."""
    v = F.col(value).cast("double")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    special = F.when(v.isNull(), COUNT).when(F.isnan(v), NOT_A_NUMBER).when(v == float("inf"), PLUS_INFINITY).when(v == float("-inf"), MINUS_INFINITY)
    count = F.array(F.struct(F.coalesce(special, F.lit(COUNT)).cast("int").alias("limb"), F.when(v.isNull(), none).otherwise(one).alias("part")))
    pieces = F.when(special.isNull() & (v != 0), F.concat(count, F.filter(_pieces(v), lambda p: p["part"] != 0))).otherwise(count)
    return _summed(df.select(*keys, F.inline(pieces)).withColumnRenamed("part", "total"), keys)


def merge_states(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The state of all rows that went into ``states``; their rows are not read again."""
    return _summed(reduce(DataFrame.unionByName, states), keys)


def _summed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "limb").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total"))


def average_of(state: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """keys, ``alias``: the average of each key, null where it has no value."""
    held = F.collect_list(F.struct("limb", F.col("total").cast("string").alias("total")))  # at most 59 rows a key
    rows = state.groupBy(*keys).agg(held.alias("_held"))
    schema = StructType([*(state.schema[k] for k in keys), StructField(alias, DoubleType())])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            averages = [average({h["limb"]: int(h["total"]) for h in row}) for row in batch.column("_held").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(averages, pa.float64())], [*keys, alias])

    return rows.mapInArrow(close, schema)


def average(held: dict[int, int]) -> float | None:
    """The average from the totals of one key, rounded once."""
    up, down = held.get(PLUS_INFINITY, 0), held.get(MINUS_INFINITY, 0)
    if held.get(NOT_A_NUMBER, 0) or (up and down):
        return float("nan")
    if up or down:
        return float("inf") if up else float("-inf")
    n = held.get(COUNT, 0)
    if not n:
        return None
    total = sum(Fraction(t) * Fraction(2) ** (LIMB_BITS * limb) for limb, t in held.items() if limb < COUNT)
    return float(total / n)


def exact_average(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """keys, ``alias``: unweighted average of ``value`` per key, the same bits under any
    order and partitioning of the rows. Nulls are skipped; infinities and
    not-a-numbers show in their key's average; a key with nulls only gives null."""
    return average_of(average_state(df, keys, value), keys, alias)
