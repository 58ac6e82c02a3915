"""Helpers shared by the operators: table access, written intermediates, bitmaps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import maybe_broadcast
from ..session import scratch_path

# A side of a join is broadcast only below both bounds (checked on written data).
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 48 * 1024 * 1024

#: A key with more than one in this many of all rows is hot, so fewer keys than this can be.
HOT_KEYS = 8192

# ASCII white space that separates words: blank, and tab to carriage return.
SEPARATORS = r"[\x20\x09-\x0D]+"
# Characters of the class above, for tests on a single character.
SEPARATOR_CHARS = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back.

    Cuts the lineage: a lost executor costs a reread, never a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is proven small, else unchanged."""
    return maybe_broadcast(df, BROADCAST_ROWS, BROADCAST_BYTES)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added where ``df`` has such a column (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups`` on ``keys`` so that no key overloads a task.

    ``groups`` has one row per key and a column ``n`` with its number of rows,
    which is dropped. Keys with more than one in ``HOT_KEYS`` of all rows counted are
    broadcast, whatever the data's size there are fewer than ``HOT_KEYS``, and their
    rows are not shuffled. The others meet in a shuffle join. ``how`` is inner or
    left. ``rows`` is evaluated twice, so it should be stored. Keys are not null.
    """
    groups = saved(groups, "groups")
    hot = F.col("n") > F.lit((groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // HOT_KEYS)
    few = F.broadcast(groups.where(hot).drop("n"))
    others = rows.join(F.broadcast(groups.where(hot).select(*keys)), keys, "left_anti").join(groups.where(~hot).drop("n"), keys, how)
    return rows.join(few, keys).unionByName(others)


def word_count(text: Column) -> Column:
    """Number of words of ``text``; 0 for null."""
    t = F.coalesce(text, F.lit(""))
    edge = F.substring(t, 1, 1).isin(SEPARATOR_CHARS).cast("long") + F.substring(t, -1, 1).isin(SEPARATOR_CHARS).cast("long")
    return F.when(t == "", F.lit(0).cast("long")).otherwise(F.size(F.split(t, SEPARATORS, -1)).cast("long") - edge)


def bitmap(df: DataFrame, key: Column, log_bits: int) -> np.ndarray:
    """A set of 64-bit hashes as 2**log_bits bits, one bit per hash.

    The size is fixed by ``log_bits``, not by the data: at most 2**(log_bits-6)
    words reach the driver. It answers "maybe present"; whoever uses it must
    get right results when every bit is set.
    """
    bit = key.bitwiseAND(F.lit((1 << log_bits) - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    words = (
        df.select(F.shiftright(bit, 6).alias("w"), one.alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toArrow()
    )
    out = np.zeros(1 << (log_bits - 6), dtype=np.uint64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` (uint64) have their bit set."""
    at = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0
