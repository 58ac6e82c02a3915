"""Collocations: phrases of frequent words that cannot be cut cheaply.

Texts are split into pieces and words. A shard (a few MB of text of one input
partition) keeps its words as ids in one sequence, pieces parted by id 0, and
indexes it in both directions: the order of its suffixes, and the order of the
suffixes of the reversed sequence with the symbol before each (its BWT). A phrase
is a pair of intervals of equal size, one in each order. Extending it to the right
takes the different symbols of its BWT interval with their counts, steps the reverse
interval by rank counts, and moves the forward interval past the smaller symbols. All
phrases of one length are extended at once. Suffixes are ordered by as many words as
phrases can have, which is all that intervals of that length need.

Counts are summed over shards. A phrase can reach the least count only if its words
and its pairs of words do, so three passes read the texts: words; pairs of frequent
words, as hashes; and all phrases, as text, whose pairs may be frequent. "May" is a
bitmap sized by the number of frequent entries (up to ``MOST_BITS``, then with more
false hits). It only saves work: counts of the last pass are exact sums over texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap, in_bitmap, saved, small
from .textwords import MULTIPLIER, chunks, mix64, word_hashes

#: Text bytes of a shard; bounds the memory of a task.
SHARD_BYTES = 6 << 20
#: A bitmap has 16 bits per frequent entry, but at most 2**MOST_BITS bits (16 MB).
MOST_BITS = 27
#: Parts in which a lang's phrases are ranked before all together.
RANK_PARTS = 32

# What parts pieces, and what parts words besides.
PIECE_MARKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"


class Shard:
    """Words of some texts: ``words`` and ``langs`` of each id, ``seq`` of ids from 1, 0 between pieces."""

    def __init__(self, chunk: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        kind = np.zeros(256, np.uint8)
        kind[list(BLANKS)] = 1
        kind[list(PIECE_MARKS)] = 2
        data = lower[data]
        kinds = kind[data]
        word = kinds == 0
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        first[edge] = word[edge]
        last[edge - 1] = word[edge - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.n = len(start)
        if not self.n:
            return
        row = np.searchsorted(offsets, start, "right") - 1
        bounds = np.empty(2 * self.n, np.int64)
        bounds[::2], bounds[1::2] = start, end
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * self.n - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        texts = texts.take(pa.array(np.arange(0, 2 * self.n - 1, 2))).dictionary_encode()
        langs = pc.fill_null(chunk.column("lang").cast(pa.string()), "und").dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False)[row].astype(np.int64)
        code = texts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        both, at, ids = np.unique(code * len(langs.dictionary) + lang, return_index=True, return_inverse=True)
        self.words = texts.dictionary.cast(pa.large_string()).take(pa.array(both // len(langs.dictionary)))
        self.langs = langs.dictionary.take(pa.array(both % len(langs.dictionary)))
        self.counts = np.bincount(ids)
        # equal for equal (lang, word) in every shard
        tags = [np.frombuffer(x.encode() + b"\0", np.uint8) for x in langs.dictionary.to_pylist()]
        tag = np.array([word_hashes(t, np.zeros(1, np.int64), np.array([len(t)]))[0] for t in tags], np.uint64)
        self.hashes = mix64(word_hashes(data, start, end)[at] + MULTIPLIER * tag[both % len(langs.dictionary)])
        marks = np.concatenate([[0], np.cumsum(kinds == 2)])[start]
        gap = np.ones(self.n, np.int64)
        gap[1:] = (marks[1:] != marks[:-1]) | (row[1:] != row[:-1])
        self.seq = np.zeros(self.n + int(gap.sum()) + 1, np.int64)
        self.seq[np.arange(self.n) + np.cumsum(gap)] = ids + 1

    def keep(self, which: np.ndarray) -> None:
        """Words other than ``which`` part pieces."""
        seq = np.concatenate([[False], which])[self.seq] * self.seq
        blank = seq == 0
        self.seq = seq[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]


def suffix_order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``seq`` in the order of the ``depth`` (rounded up to a power of two) symbols from there."""
    rank, size = seq, 1
    while size < depth:
        after = np.zeros(len(seq), np.int64)
        after[:-size] = rank[size:]
        rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1]
        size *= 2
    return np.argsort(rank, kind="stable")


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. and so on."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class TwoWayIndex:
    """Orders of a sequence and of its reverse; extends phrase intervals to the right.

    ``seq`` starts and ends with 0, which parts pieces and is in no phrase.
    """

    def __init__(self, seq: np.ndarray, depth: int):
        self.seq, self.width = seq, int(seq.max()) + 1
        self.forward = suffix_order(seq, depth)
        back = seq[::-1]
        self.bwt = back[suffix_order(back, depth) - 1]
        counts = np.bincount(seq, minlength=self.width)
        self.first = np.cumsum(counts) - counts
        self.counts = counts
        places = np.argsort(self.bwt, kind="stable")
        self.ranked = self.bwt[places] * len(seq) + places

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(forward, backward, size) of every word's intervals."""
        symbols = np.flatnonzero(self.counts[1:]) + 1
        return self.first[symbols], self.first[symbols], self.counts[symbols]

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the BWT before ``upto``."""
        return np.searchsorted(self.ranked, symbol * len(self.seq) + upto) - self.first[symbol]

    def extend(self, forward: np.ndarray, backward: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of all right extensions of the given disjoint phrases."""
        phrase = np.repeat(np.arange(len(size)), size)
        symbols = np.sort(phrase * self.width + self.bwt[ranges(backward, size)])
        at = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]])) if len(symbols) else np.zeros(0, np.int64)
        n = np.diff(np.append(at, len(symbols)))
        phrase, symbol = symbols[at] // self.width, symbols[at] % self.width
        smaller = at - (np.cumsum(size) - size)[phrase]
        real = symbol > 0
        phrase, symbol = phrase[real], symbol[real]
        return forward[phrase] + smaller[real], self.first[symbol] + self.rank(symbol, backward[phrase]), n[real]

    def phrases(self, forward: np.ndarray, length: int) -> np.ndarray:
        """The words of the phrases, one row each."""
        return self.seq[self.forward[forward][:, None] + np.arange(length)]


def pair_hashes(hashes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Hash of the pairs of word ids (from 1)."""
    return mix64(hashes[pairs[:, 0] - 1] * np.uint64(0xA0761D6478BD642F) + hashes[pairs[:, 1] - 1])


def over_shards(docs: DataFrame, emit: Callable[[Shard], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """The rows that ``emit`` gives for each shard of ``docs`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data, offsets in chunks(batch, "text", SHARD_BYTES):
                shard = Shard(chunk, data, offsets)
                if shard.n:
                    yield from emit(shard)

    return docs.select("lang", "text").mapInArrow(run, schema)


def may_be(df: DataFrame, key: str) -> np.ndarray:
    """A bitmap of the hashes ``key``, sized by their number."""
    n = df.count()
    return bitmap(df, F.col(key), max(16, min(MOST_BITS, (16 * n - 1).bit_length() if n else 0)))


def phrase_counts(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(counts, words) of ``docs`` (lang, text).

    counts: lang, phrase, size, n of every phrase of 1 to ``longest`` words that
    occurs at least ``least`` times in its lang. words: lang, n, all word occurrences.
    """
    spark = docs.sparkSession

    def words(shard: Shard) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([shard.langs, shard.words.cast(pa.string()), pa.array(shard.counts, pa.int64()), pa.array(shard.hashes.view(np.int64))], ["lang", "phrase", "n", "hash"])

    found = over_shards(docs, words, "lang string, phrase string, n long, hash long")
    found = saved(found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.first("hash").alias("hash")), "phrase-words")
    often = found.where(F.col("n") >= least)
    known = spark.sparkContext.broadcast(may_be(often, "hash"))

    def pairs(shard: Shard) -> Iterator[pa.RecordBatch]:
        shard.keep(in_bitmap(known.value, shard.hashes))
        index = TwoWayIndex(shard.seq, 2)
        forward, _, n = index.extend(*index.words())
        hashes = pair_hashes(shard.hashes, index.phrases(forward, 2))
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n, pa.int64())], ["hash", "n"])

    frequent = over_shards(docs, pairs, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    frequent = saved(frequent.select("hash"), "phrase-pairs")
    known_pairs = spark.sparkContext.broadcast(may_be(frequent, "hash"))

    def phrases(shard: Shard) -> Iterator[pa.RecordBatch]:
        shard.keep(in_bitmap(known.value, shard.hashes))
        index = TwoWayIndex(shard.seq, longest)
        spans = index.words()
        for size in range(2, longest + 1):
            spans = index.extend(*spans)
            texts = index.phrases(spans[0], size)
            kept = in_bitmap(known_pairs.value, pair_hashes(shard.hashes, texts[:, -2:]))
            spans, texts = tuple(x[kept] for x in spans), texts[kept] - 1
            if not len(texts):
                return
            joined = pc.binary_join_element_wise(*(shard.words.take(pa.array(texts[:, k])) for k in range(size)), pa.scalar(" ", pa.large_string()))
            arrays = [shard.langs.take(pa.array(texts[:, 0])), joined.cast(pa.string()), pa.array(np.full(len(texts), size, np.int32)), pa.array(spans[2], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "size", "n"])

    longer = over_shards(docs, phrases, "lang string, phrase string, size int, n long")
    longer = longer.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    counts = often.select("lang", "phrase", F.lit(1).alias("size"), "n").unionByName(longer)
    counts = saved(counts, "phrase-counts")
    known.destroy()
    known_pairs.destroy()
    return counts, found.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, share: tuple[int, int] = (80, 100), top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each lang of ``docs`` (lang, text).

    Candidates are phrases of 2 to ``longest`` words with ``least`` occurrences. The
    score is floor(2000000 a / (l + r)) for the cut with the lowest one (then the
    earliest), a, l and r being the counts of the phrase, its first part and the rest.
    A candidate goes if a longer candidate holds it and has ``share`` of its count; as
    counts only fall with length, looking one word further left and right is enough.
    Returns lang, rank, phrase, a, l, r, n, score: by score, then a, then phrase.

    A null lang is ``und``; null and empty texts hold nothing; texts without words, and
    empty tables, give no rows. Equal rows count each. Ties are broken by the phrase's
    bytes. Other columns are ignored. A shard holds whole texts, so memory follows the
    longest single text beyond ``SHARD_BYTES``.
    """
    counts, words = phrase_counts(docs, least, longest)
    wide = "cast({} as decimal(38,0))".format
    tail = F.expr("substr(phrase, instr(phrase, ' ') + 1)")
    longer = counts.where("size > 2").select("lang", F.explode(F.array(F.expr("substring_index(phrase, ' ', size - 1)"), tail)).alias("phrase"), "n")
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    candidates = counts.where("size > 1").join(small(longer), ["lang", "phrase"], "left")
    candidates = candidates.where(F.coalesce(F.expr(f"{share[1]} * {wide('most')} < {share[0]} * {wide('n')}"), F.lit(True)))
    cuts = candidates.select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("head"), F.expr("substring_index(phrase, ' ', k - size)").alias("rest"))
    parts = small(counts.where(F.col("size") < longest).select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")))
    cuts = cuts.withColumnRenamed("head", "part").join(parts, ["lang", "part"]).drop("part").withColumnRenamed("f", "l")
    cuts = cuts.withColumnRenamed("rest", "part").join(parts, ["lang", "part"]).drop("part").withColumnRenamed("f", "r")
    score = F.expr(f"(2000000 * {wide('a')}) div ({wide('l')} + {wide('r')})")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = saved(best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "phrase-scores")
    # ranked in parts first, so that a lang's last task reads at most RANK_PARTS * top rows
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return best.join(small(words), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
