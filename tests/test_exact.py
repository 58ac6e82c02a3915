"""Order-independent averages."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from starmart.operators.exact import average_of, average_state, exact_average, merge_states

KEYS = ["k", "j"]


def bits(x):
    return None if x is None else "nan" if math.isnan(x) else struct.pack("<d", x)


def rows_of(rng, n):
    def value():
        kind = rng.randrange(8)
        if kind == 0:
            return None
        if kind == 1:
            return rng.choice([0.0, -0.0, 1.0, 5e-324, -5e-324, 2.2e-308, 1.7e308, 2.0**40, 2.0**-40, -(2.0**39), 0.1])
        if kind < 5:
            return round(rng.uniform(0, 30), 1)
        return rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randrange(-300, 300)

    return [(rng.choice([None, 1, 2, 3]), rng.choice("ab"), value()) for _ in range(n)]


def plain(rows):
    out = {}
    for k, j, v in rows:
        out.setdefault((k, j), []).append(v)
    for key, values in out.items():
        held = [Fraction(v) for v in values if v is not None]
        try:
            out[key] = float(sum(held) / len(held)) if held else None
        except OverflowError:
            out[key] = math.inf
    return {k: bits(v) for k, v in out.items()}


def result(df):
    return {(r[0], r[1]): bits(r[2]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_average_is_the_nearest_double_under_any_partitioning(spark, seed):
    rng = random.Random(seed)
    rows = rows_of(rng, 400)
    df = spark.createDataFrame(rows, "k int, j string, v double")
    want = plain(rows)
    for shuffled in (df.coalesce(1), df.repartition(7), df.orderBy(F.rand(seed))):
        assert result(exact_average(shuffled, KEYS, "v", "m")) == want


def test_states_merge_without_their_rows(spark):
    rng = random.Random(9)
    sheets = [rows_of(rng, 60) for _ in range(3)]
    states = [average_state(spark.createDataFrame(s, "k int, j string, v double"), KEYS, "v") for s in sheets]
    merged = merge_states([merge_states(states[:2], KEYS), states[2]], KEYS)
    assert result(average_of(merged, KEYS, "m")) == plain([r for s in sheets for r in s])
    assert merged.columns == ["k", "j", "limb", "total"]


def test_cancelling_values_lose_nothing(spark):
    rows = [(1, "a", v) for v in (1e300, 1.0, -1e300, 2.0, 1e-300)]
    df = spark.createDataFrame(rows, "k int, j string, v double")
    assert exact_average(df, KEYS, "v", "m").first().m == 0.6


def test_special_values_and_empty_groups(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, "a", inf), (1, "a", 1.0), (2, "a", -inf), (3, "a", inf), (3, "a", -inf), (4, "a", nan), (5, "a", None), (6, "a", -0.0)]
    got = {r[0]: r[2] for r in exact_average(spark.createDataFrame(rows, "k int, j string, v double"), KEYS, "v", "m").collect()}
    assert got[1] == inf and got[2] == -inf and math.isnan(got[3]) and math.isnan(got[4]) and got[5] is None and got[6] == 0
    assert exact_average(spark.createDataFrame([], "k int, j string, v double"), KEYS, "v", "m").count() == 0
