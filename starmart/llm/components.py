"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u long, v long): root is the
    component's least node; roots have no row of their own.

    Each round points every node's larger neighbours, then every node's smaller
    ones, at its least neighbour, until nothing changes: a number of rounds that
    grows with the logarithm of the component size. Rounds end in a written
    table; only a count and two checksums reach the driver. The edges of a node
    that very many others touch stay spread over tasks. Null or equal ends are
    no edges.
    """
    now = saved(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, state = None, _state(now)
    while state != before and state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        large = saved(join_groups(both.where("v > u"), least, ["u"]).select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = join_groups(large, least, ["u"]).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
