"""Joins with a checked broadcast.

A side is broadcast only after a probe proves it small in rows and in bytes.
The probe is one distributed aggregate: every task scans its split, keeps a
partial (rows, bytes) and sends one row, so no task or driver ever holds the
side itself. (A ``limit(n + 1).count()`` probe would instead shuffle every
row of a side whose partitions each hold fewer than ``n`` rows into one task.)
Beyond either bound the join is left to the planner (sort-merge with AQE skew
splitting), which is the path that scales with both sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, MapType, StringType, StructType

# Rows of a key-only or dimension side that may be shipped to every task.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
# Bytes of such a side as rows in memory (see ``row_bytes``). The hash table is
# about twice that, which a default executor or driver (1 GB heap) holds.
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """In-memory size of one row: 8 bytes per field, plus the bytes of its
    strings and binaries, 16 per wide decimal, and nested values at the
    length of their JSON text."""
    parts: list[Column] = [F.lit(8 * (len(df.schema.fields) + 1)).cast("bigint")]
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint"))
        elif isinstance(t, DecimalType) and t.precision > 18:
            parts.append(F.lit(16).cast("bigint"))
        elif isinstance(t, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("bigint"))
    return reduce(lambda x, y: x + y, parts)


def size_of(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` from one distributed aggregate."""
    rows, size = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"),
    ).first()
    return int(rows), int(size)


def fits(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    rows, size = size_of(df)
    return rows <= max_rows and size <= max_bytes


def maybe_broadcast(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``broadcast(df)`` when it is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on,
    how: str = "left",
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Fact-to-dimension lookup; unmatched facts keep null labels (``how='left'``)."""
    return fact.join(maybe_broadcast(dim, max_rows), on, how)


def anti_join(
    left: DataFrame,
    right_keys: DataFrame,
    keys: Sequence[str],
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows of ``left`` with no equal key in ``right_keys``.

    Null keys on the right are dropped first: they can never match, and
    dropping them keeps a single null from changing the answer (unlike
    ``NOT IN``). A left row with a null key has no match and is kept.

    A right side proven small is broadcast as it is. A larger one is
    de-duplicated before the sort-merge join: the partial aggregate collapses
    a hot key in every map task, so no reducer receives its repeats. It groups
    on a hash of the keys as well, so the join puts its own exchange on the
    distinct keys: both join sides are then plain shuffles, and AQE can split a
    key that holds a third of the left rows.
    """
    keys = list(keys)
    right = right_keys.select(*keys).where(_all_not_null(keys))
    if fits(right, max_rows):
        return left.join(F.broadcast(right), keys, "left_anti")
    unique = right.withColumn("_spread", F.xxhash64(*keys)).distinct().drop("_spread")
    return left.join(unique, keys, "left_anti")


def _all_not_null(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond
