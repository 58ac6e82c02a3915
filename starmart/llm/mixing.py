"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame only).

Every source is cut into blocks of equal numbers of tokens, at most ``BLOCKS`` of
them, in shuffled document order; a slot of the mix takes one block. A source's
share of the slots is its target over its block size, so slots follow the number of sources,
not the corpus, and a small source has blocks of one token. Golden-ratio points are mapped through the
cumulative shares: point i decides which source fills slot i. Slots are ranked within
their source, the slot of rank r takes block r modulo the source's blocks, and documents
are joined with how often the blocks under them are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small, word_count

#: Blocks of a source at most; a source's words miss its target by a few blocks.
BLOCKS = 1 << 14
#: Shares of slots are counted in parts of this.
SHARE = 1 << 20
#: Documents of one source laid out by one task, about.
LAYOUT_ROWS = 10_000
GOLDEN = 2654435769  # 2**32 times the golden ratio's fraction
RANGE = 1 << 32
#: After RANGE slots the points come again; each round lies elsewhere within a step of 1 / RANGE.
FINE_BITS = 20
FINE = 648055  # 2**20 times the golden ratio's fraction
POINTS = RANGE << FINE_BITS
CELL_BITS = 40
PART_BITS = 16


def source_targets(sized: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """One row per source: sid, source, source_size and target.

    The total of all sizes is shared by weight (sources by code point, null
    last, take ``weights`` in turn); a target stops at ``max_repeats`` times its
    source's size and the excess is shared among the rest by weight. With the
    sources ordered by cap over weight the capped ones come first, so running
    sums find the final level at once. The windows see one row per source.
    """
    everything = Window.partitionBy()
    ordered = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = ordered.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    ordered = (
        ordered.withColumn("weight", F.element_at(cycle, (F.col("sid") - 1) % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
    )
    before = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    level = (
        ordered.withColumn("left_size", F.col("all_size") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("capped", F.col("cap") * F.col("left_weight") <= F.col("weight") * F.col("left_size"))
        .withColumn("free_size", F.col("all_size") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything))
        .withColumn("free_weight", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything))
    )
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("weight").cast("double") * F.col("free_size").cast("double") / F.greatest("free_weight", F.lit(1)).cast("double")
    )
    return level.select("sid", "source", "source_size", target.alias("target"))


def with_blocks(targets: DataFrame) -> tuple[DataFrame, int]:
    """``targets`` and block (tokens of a block), blocks, and the interval of points lo to hi;
    and the number of slots of the whole mix. All whole numbers from the shares on."""
    size = F.col("source_size")
    block = F.greatest(_div(size + (BLOCKS - 1), F.lit(BLOCKS)), F.lit(1).cast("long"))
    shares = targets.withColumn("block", block).withColumn("blocks", _div(size + F.col("block") - 1, F.col("block")))
    share = F.floor(F.col("target") / F.greatest(size, F.lit(1)) * F.col("blocks") * SHARE).cast("long")
    shares = shares.withColumn("share", share)
    total = shares.agg(F.coalesce(F.sum("share"), F.lit(0))).first()[0]
    upto = F.sum("share").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0))

    def bound(share: Column) -> Column:
        return _div(share.cast("decimal(38,0)") * F.lit(POINTS).cast("decimal(18,0)"), F.lit(max(total, 1)).cast("decimal(38,0)"))

    placed = shares.withColumn("upto", upto)
    placed = placed.withColumns({"lo": bound(F.col("upto") - F.col("share")), "hi": bound(F.col("upto"))})
    return placed.drop("share", "upto"), (total + SHARE // 2) // SHARE


def _div(x: Column, y: Column) -> Column:
    return F.call_function("div", x, y)


def point(slot: Column) -> Column:
    """The point of a slot, below POINTS: golden-ratio steps, in each round of RANGE slots at another fine place."""
    coarse = F.pmod(slot % RANGE * (GOLDEN - RANGE), F.lit(RANGE))
    return coarse * (1 << FINE_BITS) + ((1 << FINE_BITS) - 1) - _div(slot, F.lit(RANGE)) * FINE % (1 << FINE_BITS)


def schedule(sources: DataFrame, slots: int, max_repeats: int) -> DataFrame:
    """Slots (slot, sid, rank, epoch, number): which block of which source comes when.

    Sources are matched by an equi-join on cells of the points. Ranks are counted
    in parts of the slots and the parts' counts are summed, so a source is many
    tasks. A source's slots beyond ``max_repeats`` passes stay unused.
    """
    spark = sources.sparkSession
    points = spark.range(slots).select(F.col("id").alias("slot"), F.shiftright("id", PART_BITS).alias("part"), point(F.col("id")).alias("x"))
    points = points.withColumn("cell", F.shiftright("x", CELL_BITS))
    cells = sources.where("lo < hi").select("sid", "blocks", "lo", "hi").withColumn(
        "cell", F.explode(F.sequence(F.shiftright("lo", CELL_BITS), F.shiftright(F.col("hi") - 1, CELL_BITS)))
    )
    dealt = points.join(small(cells), "cell").where("x >= lo and x < hi").select("slot", "part", "sid", "blocks")
    counts = dealt.groupBy("sid", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sid", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("sid", "part").orderBy("slot")).cast("long") - 1
    ranked = dealt.withColumn("inner", within).join(counts, ["sid", "part"]).withColumn("rank", F.col("base") + F.col("inner"))
    ranked = ranked.where(F.col("rank") < F.col("blocks") * max_repeats)
    return ranked.select("slot", "sid", "rank", _div(F.col("rank"), F.col("blocks")).alias("epoch"), (F.col("rank") % F.col("blocks")).alias("number"))


def block_use(sources: DataFrame, slots: int, max_repeats: int) -> DataFrame:
    """sid, number, uses, before: how often each block is taken, and how many words of
    its source's mix the blocks before it give. One row more than blocks, for the end."""
    used = schedule(sources, slots, max_repeats).groupBy("sid", "number").agg(F.count(F.lit(1)).alias("uses"))
    blocks = sources.select("sid", "block", "source_size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks"))).alias("number"))
    blocks = blocks.join(used, ["sid", "number"], "left").withColumn("uses", F.coalesce("uses", F.lit(0).cast("long")))
    tokens = F.least(F.col("block"), F.col("source_size") - F.col("number") * F.col("block"))
    before = F.sum(F.col("uses") * tokens).over(Window.partitionBy("sid").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    return blocks.select("sid", "number", "uses", F.coalesce(before, F.lit(0)).cast("long").alias("before"))


def laid_out(sized: DataFrame, sources: DataFrame, rows: int) -> DataFrame:
    """Documents with their source's sid and first token's place in it.

    The order within a source is that of ``order``, an md5 of doc_id and text. Its
    leading hex digits cut a source, however large, into parts of about ``LAYOUT_ROWS``
    documents whose running sums are taken apart. Rows equal in both are one row until
    their places are known, so a row repeated very often is no burden to its part.
    """
    digits = max(1, len(f"{max(rows // LAYOUT_ROWS, 1):x}"))
    columns = ["doc_id", "source", "size", "order"]
    copies = sized.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    of = small(sources.select("sid", F.col("source").alias("of"), "source_size", "target", "block"))
    keyed = copies.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("part", F.substring("order", 1, digits))
    keyed = saved(keyed, "mix-layout")
    all_of = F.col("size") * F.col("copies")
    parts = keyed.groupBy("sid", "part").agg(F.sum(all_of).alias("part_size"))
    before = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("sid", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("sid", "part").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inner", F.coalesce(F.sum(all_of).over(within), F.lit(0))).join(small(saved(parts, "mix-parts")), ["sid", "part"])
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    start = F.col("base") + F.col("inner") + F.col("copy") * F.col("size")
    return placed.select("doc_id", "size", "source", "sid", "source_size", "target", "block", start.alias("start"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """doc_id, size, source, source_size, target, taken of every row of ``docs``
    (doc_id, text, source; other columns are ignored).

    ``size`` counts words. ``taken`` is how many words of the row the mix takes,
    repeats counted: never more than ``max_repeats`` times its size. A source's
    taken words differ from its target by a few of its blocks, however large the corpus.

    Null or empty texts have size 0 and take 0. A null source is a source of its
    own, the last. Null doc_ids are laid out like any value. Rows repeated in
    doc_id, source and text are separate documents. An empty table gives an
    empty result. A very long text lies in many blocks and is one row throughout.
    """
    order = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))))
    return mix_sized(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), order.alias("order")), weights, max_repeats)


def mix_sized(sized: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """``mix`` of rows whose size is known (doc_id, source, size, order)."""
    sized = saved(sized, "mix-sizes")
    sources, slots = with_blocks(saved(source_targets(sized, weights, max_repeats), "mix-targets"))
    sources = saved(sources, "mix-sources")
    use = small(saved(block_use(sources, slots, max_repeats), "mix-blocks"))
    placed = laid_out(sized, sources, sized.count())

    def upto(docs: DataFrame, at: str, name: str) -> DataFrame:
        """How many words the mix takes of the source before the place ``at``."""
        found = docs.withColumn("number", _div(F.col(at), F.col("block"))).join(use, ["sid", "number"])
        return found.withColumn(name, F.col("before") + F.col("uses") * (F.col(at) - F.col("number") * F.col("block"))).drop("number", "uses", "before")

    placed = upto(upto(placed.withColumn("end", F.col("start") + F.col("size")), "start", "first"), "end", "last")
    return placed.select("doc_id", "size", "source", "source_size", "target", (F.col("last") - F.col("first")).alias("taken"))
