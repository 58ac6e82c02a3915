"""N-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row per document and a column per word n-gram; its product with
its own transpose counts the n-grams any two documents share. Equal rows are
taken once. In the order of n-grams those held by one row come first (they
cannot count and are left out of the product), then those held by a few. Two rows can reach the threshold only if they share one of their first
n-grams (a prefix whose length follows from the row's size), so rows that share
such n-grams, directly or in a chain, form a cluster and only clusters are
multiplied. A cluster is cut into bands by size; bands further apart than the
threshold allows are never multiplied, and a band is cut into blocks of bounded
size. A task multiplies two blocks, drops pairs below the size-derived bound and
returns links that span the blocks' own components, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap, in_bitmap, join_groups, saved
from .components import connected
from .textwords import chunks, mix64, row_bounds, window_hashes, word_hashes, word_spans

#: Documents and n-grams of a block at most (one document at least).
BLOCK_DOCS = 256
BLOCK_GRAMS = 1_000_000
#: n-grams of one part when repeated ones are looked for, about.
PART_GRAMS = 1 << 20
#: n-grams a task gathers before it hands them to the parts.
HELD_GRAMS = 2 << 20
#: An n-gram met more often than this is common and comes last in the order.
COMMON = 8
LOG_BITS = 26
LAST = (1 << 63) - 1


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; all words as one if fewer than n."""
    row, start, end = word_spans(data, offsets)
    words = word_hashes(data, start, end, lower=True)
    grams = window_hashes(words, n)
    bounds = row_bounds(row, len(offsets) - 1)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            x = np.sort(grams[a : b - n + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        else:
            out.append(window_hashes(words[a:b], b - a) if b > a else words[:0])
    return out


def node_of(grams: np.ndarray) -> int:
    """64-bit identity of a set, as a signed long."""
    total = np.add.reduce(mix64(grams ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)
    return int(mix64(np.array([total ^ np.uint64(len(grams))], np.uint64)).view(np.int64)[0])


def tags_of(nodes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of a row's set and doc_id."""
    return mix64(nodes.view(np.uint64) ^ mix64(at.view(np.uint64) + np.uint64(1)))


def prefix_size(size: int, num: int, den: int) -> int:
    """Elements of which two sets with Jaccard num/den or more must share one."""
    return size + (-num * size) // den + 1


def _repeated_grams(texts: DataFrame, rows_of, first_tags, grams: int, log_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the n-grams that stand in two or more different sets, and of the common ones.

    Tasks deal their n-grams into parts by hash and hand each part 32 further
    bits of every n-gram, so that a part finds what repeats by sorting 4 bytes
    each. An n-gram is handed on at most twice per gathered lot, so one that a
    third of all documents hold does not swell its part. The number of parts
    follows the number of n-grams.
    """
    bits = max(0, min(16, (max(grams, 1) // PART_GRAMS).bit_length()))
    low = 32  # log_bits is at most this, so what a part sees fixes the place in the bitmap

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush():
            x = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            held.clear()
            if len(x):
                third = np.concatenate([[False, False], (x[2:] == x[:-2])]) if len(x) > 2 else np.zeros(len(x), bool)
                x = x[~third]
                part = (x >> np.uint64(low)).astype(np.int64)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(x)]])
                raw = [x[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), pa.array(raw, pa.binary())], names=["part", "grams"])

        for batch in batches:
            for _, found, _, tags in rows_of(batch):
                keep = np.flatnonzero(in_bitmap(first_tags.value, tags))
                held += [found[k] & np.uint64((1 << (low + bits)) - 1) for k in keep]
                if sum(map(len, held)) > HELD_GRAMS:
                    yield from flush()
        yield from flush()

    def repeats(group):
        x = np.sort(np.concatenate([np.frombuffer(b, np.uint32) for b in group.column("grams").to_pylist()]))
        x, n = np.unique(x, return_counts=True)
        x, n = x[n > 1].astype(np.int64) & ((1 << log_bits) - 1), n[n > 1]
        order = np.argsort(x, kind="stable")
        bit = np.uint64(1) << (x[order] & 63).astype(np.uint64)
        word, first = np.unique(x[order] >> 6, return_index=True)
        both = [np.bitwise_or.reduceat(b, first) if len(first) else bit for b in (bit, np.where(n[order] > COMMON, bit, np.uint64(0)))]
        return pa.table({"w": word, "b": both[0].view(np.int64), "c": both[1].view(np.int64)})

    dealt = texts.mapInArrow(deal, "part long, grams binary").groupBy("part").applyInArrow(repeats, "w long, b long, c long")
    got = dealt.groupBy("w").agg(F.bit_or("b").alias("b"), F.bit_or("c").alias("c")).toArrow()
    out = np.zeros((2, 1 << (log_bits - 6)), np.uint64)
    for k, name in enumerate("bc"):
        out[k, got.column("w").to_numpy()] = got.column(name).to_numpy().view(np.uint64)
    return out[0], out[1]


def block_links(sizes: np.ndarray, held: np.ndarray, flat: np.ndarray, left: np.ndarray, right: np.ndarray, num: int, den: int) -> np.ndarray:
    """Component label (an index) of each set of two blocks, linking only across
    them (or within, if they are the same). ``flat``: the sets one after another,
    ``held`` members of each, which may leave out those of no other set."""
    n = len(sizes)
    row = np.repeat(np.arange(n), held)
    order = np.argsort(flat, kind="stable")
    column = np.cumsum(np.concatenate([[0], flat[order][1:] != flat[order][:-1]]))
    count = np.bincount(column)
    use = count[column] > 1
    row, column = row[order][use], column[use]
    count = count[column]
    shared = np.zeros((n, n), np.float32)
    rare = count <= 16
    r, c = row[rare], column[rare]
    for d in range(1, 16):  # sparse part: rows at distance d in one column's list
        same = c[d:] == c[:-d]
        if not same.any():
            break
        shared += np.bincount(r[:-d][same] * n + r[d:][same], minlength=n * n).reshape(n, n)
    r = row[~rare]
    if len(r):
        c = np.cumsum(np.concatenate([[0], np.diff(column[~rare]) != 0]))
        for at in range(0, int(c[-1]) + 1, 4096):  # dense part, column by column block
            mine = (c >= at) & (c < at + 4096)
            m = np.zeros((n, 4096), np.float32)
            m[r[mine], c[mine] - at] = 1
            shared += np.triu(m @ m.T, 1)
    shared += shared.T
    total = sizes[:, None] + sizes[None, :]
    link = shared.astype(np.int64) * (den + num) >= num * total
    link &= (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    np.fill_diagonal(link, True)
    label = np.arange(n)
    while True:
        new = np.where(link, label[None, :], n).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, log_bits: int = LOG_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id, component, body of every row of ``docs``
    (doc_id, text); body is ``xxhash64(text)``, component a hash naming the component
    (components without any doc_id differ in it alone).

    Texts are lower-cased (A-Z); a document's set holds its distinct ``n``-word
    shingles, or its whole word sequence if that is shorter. Documents link when
    the Jaccard index of their sets is num/den or more. ``component_id`` is the
    smallest doc_id reachable over links.

    Null and empty texts and texts without words have the empty set and link
    with nothing: their component_id is their own doc_id. Null doc_ids take part
    and are never the smallest unless alone. Repeated rows stay, in one
    component. Other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("at"), F.xxhash64("text").alias("body"), "text")

    def rows_of(batch):
        for rows, data, offsets in chunks(batch, "text"):
            sets = gram_sets(data, offsets, n)
            nodes = np.array([node_of(s) for s in sets], np.int64)
            yield rows, sets, nodes, tags_of(nodes, rows.column("at").to_numpy())

    def lists(parts) -> pa.Array:
        cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat.view(np.int64)))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets, nodes, tags in rows_of(batch):
                columns = [rows.column("at"), rows.column("body"), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes), pa.array(tags.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "body", "size", "node", "tag"])

    sets = saved(texts.mapInArrow(describe, "at long, body long, size long, node long, tag long"), "gram-sets")
    firsts = saved(sets.where("size > 0").groupBy("node").agg(F.min(F.struct("at", "tag")).alias("one"), F.first("size").alias("size")), "gram-nodes")
    first_tags = spark.sparkContext.broadcast(bitmap(firsts, F.col("one.tag"), log_bits))
    grams = firsts.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    repeated = spark.sparkContext.broadcast(_repeated_grams(texts, rows_of, first_tags, grams, log_bits))

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found, nodes, tags in rows_of(batch):
                keep = np.flatnonzero(in_bitmap(first_tags.value, tags))
                parts = []
                for k in keep:
                    twice = found[k][in_bitmap(repeated.value[0], found[k])]
                    left = prefix_size(len(found[k]), num, den) - (len(found[k]) - len(twice)) if len(twice) else 0
                    last = in_bitmap(repeated.value[1], twice) if left > 0 else None
                    parts.append(np.concatenate([twice[~last], twice[last]])[:left] if left > 0 else twice[:0])
                node = np.repeat(nodes[keep], [len(x) for x in parts])
                flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(flat.view(np.int64))], names=["node", "g"])

    posted = saved(texts.mapInArrow(postings, "node long, g long"), "gram-postings")
    shared = posted.groupBy("g").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high").drop("high")
    met = join_groups(posted, shared, ["g"]).where("node != low").select("node", "low").distinct()
    clusters = connected(met.select(F.col("node").alias("u"), F.col("low").alias("v")))
    clusters = saved(clusters.unionByName(clusters.select(F.col("root").alias("node"), "root").distinct()), "gram-clusters")
    members = clusters.join(firsts, "node").select("node", F.col("root").alias("cluster"), "size", "one.tag")
    width = math.log(den / num * 1.001) if num < den else 1e-9
    members = saved(members.withColumn("band", F.floor(F.log("size") / F.lit(width)).cast("long") if num < den else F.col("size")), "gram-members")
    wanted = spark.sparkContext.broadcast(bitmap(members, F.col("tag"), log_bits))

    by_cluster, by_band = Window.partitionBy("cluster"), Window.partitionBy("cluster").orderBy("band")
    bands = members.groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("grams"))
    one = (F.sum("docs").over(by_cluster) <= BLOCK_DOCS) & (F.sum("grams").over(by_cluster) <= BLOCK_GRAMS)
    cuts = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    bands = bands.withColumns({"one": one, "cuts": cuts})
    bands = bands.withColumns(
        {
            "below": F.when(F.lag("band").over(by_band) == F.col("band") - 1, F.lag("cuts").over(by_band)).otherwise(0),
            "above": F.when(F.lead("band").over(by_band) == F.col("band") + 1, F.lead("cuts").over(by_band)).otherwise(0),
        }
    ).drop("docs", "grams")

    def rows_wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found, nodes, tags in rows_of(batch):
                keep = np.flatnonzero(in_bitmap(wanted.value, tags))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[keep]), pa.array(tags[keep].view(np.int64)), lists([found[k][in_bitmap(repeated.value[0], found[k])] for k in keep])], names=["node", "tag", "grams"]
                )

    matrix = texts.mapInArrow(rows_wanted, "node long, tag long, grams array<long>")
    placed = members.join(bands, ["cluster", "band"]).withColumn("sub", F.pmod("node", F.col("cuts").cast("long")))

    def block(band, sub):
        return band * F.lit(1 << 24) + sub

    def numbers(count):
        return F.when(count > 0, F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)).otherwise(F.array().cast("array<long>"))

    own, band, sub = block(F.col("band"), F.col("sub")), F.col("band"), F.col("sub")
    pairs = F.concat(
        F.transform(numbers(F.col("cuts")), lambda j: F.struct(block(band, F.least(j, sub)).alias("x"), block(band, F.greatest(j, sub)).alias("y"))),
        F.transform(numbers(F.col("above")), lambda j: F.struct(own.alias("x"), block(band + 1, j).alias("y"))),
        F.transform(numbers(F.col("below")), lambda j: F.struct(block(band - 1, j).alias("x"), own.alias("y"))),
    )
    single = F.array(F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y")))
    placed = placed.select("node", "tag", "cluster", "size", F.when(F.col("one"), F.lit(0)).otherwise(own).alias("own"), F.when(F.col("one"), single).otherwise(pairs).alias("pairs"))
    dealt = matrix.join(placed, ["node", "tag"]).select("cluster", "own", "node", "size", "grams", F.explode("pairs").alias("pair")).select("cluster", "pair.*", "own", "node", "size", "grams")

    def multiply(key, group):
        node, own_block = group.column("node").to_numpy(), group.column("own").to_numpy()
        node, at = np.unique(node, return_index=True)  # repeated rows bring a set twice
        arrays = group.column("grams").combine_chunks()
        found = [arrays[int(k)].values.to_numpy().view(np.uint64) for k in at]
        x, y = key[1].as_py(), key[2].as_py()
        sizes, held = group.column("size").to_numpy()[at], np.array([len(f) for f in found], np.int64)
        label = block_links(sizes, held, np.concatenate(found), own_block[at] == x, own_block[at] == y, num, den)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"u": node[linked], "v": node[label[linked]]})

    links = saved(dealt.groupBy("cluster", "x", "y").applyInArrow(multiply, "u long, v long"), "gram-links")
    for sent in (first_tags, repeated, wanted):
        sent.destroy()
    roots = connected(links)
    named = sets.select("at", "body", "size", "node").join(roots, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("node", "root")
    named = saved(named, "gram-components")
    filled = named.where("size > 0")
    least = filled.groupBy("component").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    out = join_groups(filled, least, ["component"]).unionByName(named.where("size = 0").withColumn("first", F.col("at")))
    return out.select(
        F.when(F.col("at") != LAST, F.col("at")).alias("doc_id"), F.col("size").alias("n_shingles"), F.when(F.col("first") != LAST, F.col("first")).alias("component_id"), "component", "body"
    )
