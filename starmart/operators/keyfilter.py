"""A filter of the keys that a set of rows holds, as a table built by one aggregate.

A filter has a power-of-two number of 64-bit words, about 24 bits a key. A key's
hash picks one word and ``BITS`` of its bits. A key whose bits are not all set is
not among the rows; one whose bits are set may be (about one of 2,000 others).
Building is a partial and final ``bit_or`` per word, so it shuffles words, never
keys, and equal keys collapse in the map tasks. Whether a key may be held is a join
on the word, so neither side is held in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 5
BITS_PER_KEY = 24


def filter_words(rows: int) -> int:
    """Number of words for ``rows`` keys: a power of two."""
    return 1 << (-(-max(1, rows) * BITS_PER_KEY // 64) - 1).bit_length()


def _place(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """(word, bits) of a row's key."""
    h = F.xxhash64(*keys)
    word = F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(words - 1)) if words <= 1 << 32 else F.pmod(F.xxhash64(h), F.lit(words))
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(BITS)]
    return word.alias("word"), reduce(lambda a, b: a.bitwiseOR(b), bits).alias("bits")


def key_filter(rows: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """(word, bits) of the keys of ``rows``; null keys match nothing and are left out."""
    found = rows.select(*keys).dropna()
    return found.select(*_place(keys, words)).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def may_hold(filters: DataFrame, words: int, batch_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch_keys`` that filters of ``words`` words may hold, with the other columns
    of ``filters`` (word, bits, and what names a filter)."""
    word, bits = _place(keys, words)
    wanted = batch_keys.select(*keys, word, bits.alias("wanted"))
    met = filters.join(F.broadcast(wanted), "word").where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    return met.drop("word", "bits", "wanted")
