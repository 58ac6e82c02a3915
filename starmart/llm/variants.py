"""Spelling variants: words one edit apart, and the frequent form each belongs to.

Two words one edit apart agree before and after one place, so they share a first
half or a last half. Rows of words are grouped by (length of the shorter word,
shared halves) and each group is a short sorted list. The list is scanned once per
word with a banded edit matrix of three cells a row: rows stay valid as far as the
next word agrees with the last one (their LCP), and when a row has no cell of one
edit or less, all words that share that prefix are skipped.

A group that is too large for one task is split: what is left between the shared
parts is halved again, and its pairs share more on the left or on the right. Which
side follows from the place where a pair first differs, so every pair is found in
one group only and none is lost, however the vocabulary is distributed.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small

#: Most rows of a group, unless only one letter is left between its shared parts.
GROUP_ROWS = 2048
#: A form must be this many times as frequent as its variant.
TIMES = 10

# Letters of a word, and those that are lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def observed_words(docs: DataFrame, least_length: int = 7, least_count: int = 2, one_in: int = 31) -> DataFrame:
    """word, n of the letter runs of ``docs`` (doc_id, text), with planted deletions.

    Runs are lower-cased (A-Z only). Where ``one_in`` divides the crc32 h of
    ``<doc_id>:<run>`` (a null doc_id is empty), code point h % length is deleted.
    Words shorter than ``least_length`` code points or rarer than ``least_count`` go.
    """
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({LETTERS}{{{least_length},}})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    without = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = rows.select(F.when(h % one_in == 0, without).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# Rows of the banded matrix as numbers: cells (one before, on, one after the diagonal), each 0, 1 or more.
DEAD = 26
FIRST_ROW = 2 * 9 + 0 * 3 + 1


def next_rows() -> list[int]:
    """Row after (row, does the letter equal the word's letter before / on / after the diagonal)."""
    out = []
    for a, b, c in product(range(3), repeat=3):
        for before, on, after in product((0, 1), repeat=3):
            x = min(a + 1 - before, b + 1, 2)
            y = min(b + 1 - on, c + 1, x + 1, 2)
            z = min(c + 1 - after, y + 1, 2)
            out.append(x * 9 + y * 3 + z)
    return out


NEXT = next_rows()


def shared(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def near_in_list(words: list[str]) -> Iterator[tuple[int, int]]:
    """(i, j), i < j, of the words of a sorted list that are one edit apart."""
    lcp = [0] + [shared(a, b) for a, b in zip(words, words[1:])]
    for i, q in enumerate(words):
        padded = "\0" + q + "\0\0\0"  # no letter, so it never matches
        size = len(q)
        rows = [FIRST_ROW]
        for d, x in enumerate(q):
            rows.append(NEXT[rows[d] * 8 + (x == padded[d]) * 4 + 2 + (x == padded[d + 2])])
        j, depth = i + 1, size
        while j < len(words):
            word = words[j]
            d = min(depth, lcp[j])
            row = rows[d]
            del rows[d + 1 :]
            while row != DEAD and d < len(word) and d <= size + 1:
                x = word[d]
                row = NEXT[row * 8 + (x == padded[d]) * 4 + (x == padded[d + 1]) * 2 + (x == padded[d + 2])]
                rows.append(row)
                d += 1
            depth = d
            if d < len(word) or row == DEAD:  # no word with this prefix is near
                j += 1
                if j < len(words) and lcp[j] >= d:
                    j = bisect_left(words, word[:d] + "\U0010ffff", j)
                continue
            cell = (row // 9, row // 3 % 3, row % 3)[size - len(word) + 1] if abs(size - len(word)) <= 1 else 2
            if cell == 1:
                yield i, j
            j += 1


def _groups(words: DataFrame) -> DataFrame:
    """word, n, small (length of a pair's shorter word), head and tail (letters shared on either side)."""
    size = F.length("word")
    choices = [F.struct((size - k).alias("small"), head.alias("head"), tail.alias("tail")) for k in (0, 1) for head, tail in _halves(size - k)]
    least = words.agg(F.min(size)).first()[0] or 0
    rows = words.select("word", "n", F.explode(F.array(*choices)).alias("at")).select("word", "n", "at.*")
    return rows.where(F.col("small") >= least)


def _halves(middle: Column) -> list[tuple[Column, Column]]:
    first = F.floor(middle / 2).cast("int")
    return [(first, F.lit(0)), (F.lit(0), (middle - first).cast("int"))]


def _keyed(rows: DataFrame) -> DataFrame:
    head = F.substr("word", F.lit(1), F.col("head"))
    tail = F.when(F.col("tail") > 0, F.substr("word", F.length("word") - F.col("tail") + 1)).otherwise("")
    return rows.withColumn("key", F.xxhash64(head, F.lit("\0"), tail))


def grouped(words: DataFrame, most: int = GROUP_ROWS) -> DataFrame:
    """Rows of ``words`` in groups of at most ``most`` rows (key, small, head, tail)."""
    at = ["key", "small", "head", "tail"]
    rows, out = saved(_keyed(_groups(words)), "variant-rows"), None
    while True:
        hot = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > most) & (F.col("small") - F.col("head") - F.col("tail") > 1))
        hot = saved(hot.select(*at), "variant-hot")
        if hot.isEmpty():
            return rows if out is None else out.unionByName(rows)
        hot = small(hot)
        cool = rows.join(hot, at, "left_anti")
        out = cool if out is None else out.unionByName(cool)
        middle = F.col("small") - F.col("head") - F.col("tail")
        parts = F.array(*(F.struct((F.col("head") + h).alias("head"), (F.col("tail") + t).alias("tail")) for h, t in _halves(middle)))
        split = rows.join(hot, at, "left_semi").select("word", "n", "small", F.explode(parts).alias("at")).select("word", "n", "small", "at.*")
        rows = saved(_keyed(split), "variant-rows")


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, near, near_n: how many words of ``words`` (word, n) are one edit
    apart, and the most frequent of them (ties: first in code-point order). Words
    without any have no row. Words are different from each other."""
    at = ["key", "small", "head", "tail"]
    rows = grouped(words).repartition(*at).sortWithinPartitions(*at, "word")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table]).combine_chunks()
            cuts = bounds(table)
            yield near_in_groups(table, cuts)
            left = table.slice(int(cuts[-1]))
        if left is not None and left.num_rows:
            yield near_in_groups(left, np.append(bounds(left), left.num_rows))

    def bounds(table: pa.Table) -> np.ndarray:
        """First rows of the groups."""
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for name in at:
            values = table.column(name).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new) if len(new) else np.zeros(1, np.int64)

    def near_in_groups(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        many = np.flatnonzero(np.diff(cuts) > 1)
        out = []
        for lo, hi in zip(cuts[many].tolist(), cuts[many + 1].tolist()):
            group = table.slice(lo, hi - lo)
            names, n = group.column("word").to_pylist(), group.column("n").to_pylist()
            shorter, head, tail = (group.column(c)[0].as_py() for c in ("small", "head", "tail"))
            found: dict[int, list] = {}
            for i, j in near_in_list(names):
                a, b = names[i], names[j]
                first = shared(a, b)
                if min(len(a), len(b)) != shorter or first < head or (tail and first >= shorter - tail):
                    continue
                for x, y in ((i, j), (j, i)):
                    if x in found:
                        found[x][0] += 1
                        found[x][1] = min(found[x][1], (-n[y], names[y]))
                    else:
                        found[x] = [1, (-n[y], names[y])]
            out += [(names[x], count, best, -minus) for x, (count, (minus, best)) in found.items()]
        columns = list(zip(*out)) or [[], [], [], []]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["word", "n_near", "near", "near_n"])

    found = rows.mapInArrow(scan, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", "best.near", (-F.col("best.minus")).alias("near_n"))


def variant_groups(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n).

    form is the most frequent near word if it is ``times`` as frequent, else null;
    root is the last word reached by following forms (the word itself without one).
    Counts grow by ``times`` with each step, so chains are as long as the logarithm of
    the largest count and are followed by doubling.

    Words are not null and differ from each other; an empty table gives no rows. Memory
    holds one group; a very long word is a row like any other.
    """
    words = saved(words.select("word", "n"), "variant-words")
    found = words.join(near_words(words), "word", "left")
    is_form = F.col("near_n") >= F.lit(times) * F.col("n")
    found = found.select(
        "word",
        F.when(is_form, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    found = saved(found, "variant-forms")
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        step = saved(roots.join(up, "root", "left").select("word", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")), "variant-roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Variants among the observed words of ``docs`` (doc_id, text).

    Null and empty texts hold no word; equal rows count each; an empty table gives no
    rows; other columns are ignored; texts of any length are split where they stand.
    """
    return variant_groups(observed_words(docs))
