"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A benchmark item of m words leaks into a text if some stretch of the text has a
word edit distance of at most ``max_edit`` * m to it. Windows of the item's size
are embedded by the CGK random walk (a step copies the word under the pointer;
random bits of step and word decide whether the pointer moves on), which turns
edit distance into Hamming distance. A table samples a few of the embedding's
coordinates; tables are repeated until the target recall is reached. Windows
that meet an item in a table are verified by exact edit distance.

Which windows: of m words with k edits, one of k + 1 equal pieces is untouched, so
a leak holds one of the item's q-grams, q = m // (k + 1), at its place shifted by
at most k. Windows are laid where such a q-gram of an item stands in the text;
other windows cannot be leaks.

Benchmarks go to the tasks in blocks of bounded bytes, one pass over the documents
per block, each written before the next; documents are neither shuffled nor joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import saved, unused
from .textwords import chunks, mix64, row_bounds, window_hashes, word_hashes, word_spans

MAX_EDIT = 0.2
#: Longest q-gram used to place windows.
MOST_GRAM = 4
#: Coordinates per table, and a low share of equal coordinates at the largest
#: distance (not the mean, 0.45: it varies by size and by place of the edits);
#: the number of tables follows from the target recall.
SAMPLED = 3
AGREEMENT = 0.35
RECALL = 0.99
#: Benchmark text sent to the tasks at once, and places of windows held at once.
BLOCK_BYTES = 4 << 20
PLACES = 1 << 20
LEAKS = "array<struct<item_id:long,distance:int,item_words:int,first_word:int>>"


def tables_for(recall: float = RECALL, agreement: float = AGREEMENT, sampled: int = SAMPLED) -> int:
    """Tables needed so that a pair with this agreement meets in one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**sampled))


def cgk_keys(windows: np.ndarray, tables: int, sampled: int = SAMPLED) -> np.ndarray:
    """(windows x tables) keys of equally long windows of word hashes.

    Every table has its own walk of up to 2 m steps and its own coordinates.
    Past its end a window yields the word 0.
    """
    n, m = windows.shape
    padded = np.hstack([windows, np.zeros((n, 1), np.uint64)])
    rng = np.random.default_rng(m)
    picks = np.stack([rng.permutation(2 * m)[:sampled] for _ in range(tables)])
    number = np.arange(1, tables + 1, dtype=np.uint64)
    steps = mix64(np.arange(2 * m, dtype=np.uint64)[:, None] + number * np.uint64(1_000_003))
    row = np.arange(n)[:, None]
    at, keys = np.zeros((n, tables), np.int64), np.tile(number, (n, 1))
    for j in range(int(picks.max()) + 1):  # all tables walk together
        word = padded[row, at]
        taken = np.flatnonzero((picks == j).any(1))
        if len(taken):
            keys[:, taken] = mix64(keys[:, taken] * np.uint64(0x9E3779B97F4A7C15) + word[:, taken])
        at += ((mix64(word ^ steps[j]) >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
        np.minimum(at, m, out=at)
    return keys


def infix_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any stretch of ``text``, and where that ends."""
    n = len(text)
    steps = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty(n + 1, np.int64)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    end = int(np.argmin(row))
    return int(row[end]), end


@dataclass
class Items:
    """A block of benchmark items ready for the tasks."""

    ids: list[int | None]
    words: list[np.ndarray]
    edits: np.ndarray
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # q: sorted hashes, size of the item, place in it; each once
    keys: dict[int, list[dict[int, list[int]]]]  # size: per table key -> items
    tables: int


def prepared(items: list[tuple[int | None, str]], max_edit: float, tables: int) -> Items:
    """Items without a word are left out."""
    texts = [(t or "").encode() for _, t in items]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    row, start, end = word_spans(data, offsets, letters_only=True)
    hashes = word_hashes(data, start, end, lower=True)
    bounds = row_bounds(row, len(texts))
    kept = [k for k in range(len(texts)) if bounds[k + 1] > bounds[k]]
    words = [hashes[bounds[k] : bounds[k + 1]] for k in kept]
    edits = np.array([int(max_edit * len(w)) for w in words], np.int64)
    grams: dict[int, list] = {}
    for i, w in enumerate(words):
        q = min(MOST_GRAM, max(1, len(w) // (int(edits[i]) + 1)))
        h = window_hashes(w, q)
        grams.setdefault(q, []).append((h, np.full(len(h), len(w)), np.arange(len(h))))
    sorted_grams = {}
    for q, parts in grams.items():
        found = [np.concatenate(x) for x in zip(*parts)]
        order = np.lexsort(found[::-1])
        h, size, place = (x[order] for x in found)
        # items of one size that share a stretch place the same windows
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (size[1:] != size[:-1]) | (place[1:] != place[:-1])])
        sorted_grams[q] = (h[new], size[new], place[new])
    keys: dict[int, list[dict[int, list[int]]]] = {}
    for size in sorted({len(w) for w in words}):
        mine = [i for i, w in enumerate(words) if len(w) == size]
        got = cgk_keys(np.stack([words[i] for i in mine]), tables)
        found: list[dict[int, list[int]]] = [{} for _ in range(tables)]
        for t in range(tables):
            for i, key in zip(mine, got[:, t].tolist()):
                found[t].setdefault(key, []).append(i)
        keys[size] = found
    return Items([items[k][0] for k in kept], words, edits, sorted_grams, keys, tables)


def placed_windows(words: np.ndarray, row: np.ndarray, items: Items) -> np.ndarray:
    """Distinct (row, size, start) where an item's q-gram stands; start within the chunk, perhaps before the row."""
    found = []
    for q, (known, size, place) in items.grams.items():
        grams = window_hashes(words, q)
        if not len(grams):
            continue
        bits = np.zeros(1 << 20, bool)
        bits[(known & np.uint64(0xFFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(bits[(grams & np.uint64(0xFFFFF)).astype(np.int64)] & (row[: len(grams)] == row[q - 1 :]))
        lo, hi = np.searchsorted(known, grams[at], "left"), np.searchsorted(known, grams[at], "right")
        upto = np.cumsum(hi - lo)
        begin = 0
        while begin < len(at):  # about PLACES at once, duplicates go before the next
            before = upto[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(upto, before + PLACES, "right")))
            many = (hi - lo)[begin:stop]
            stands = np.repeat(at[begin:stop], many)
            k = np.repeat(lo[begin:stop] - (np.cumsum(many) - many), many) + np.arange(len(stands))
            found.append(np.unique(np.column_stack([row[stands], size[k], stands - place[k]]), axis=0))
            begin = stop
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def leaks_of(words: np.ndarray, row: np.ndarray, n_rows: int, items: Items) -> dict[int, dict[int, tuple[int, int]]]:
    """row -> item -> (distance, first word within the row) of the chunk's leaks."""
    bounds = row_bounds(row, n_rows)
    windows = placed_windows(words, row, items)
    out: dict[int, dict[int, tuple[int, int]]] = {}
    for size in np.unique(windows[:, 1]).tolist():
        mine = windows[windows[:, 1] == size]
        for lo in range(0, len(mine), 2048):
            part = mine[lo : lo + 2048]
            begin, stop = bounds[part[:, 0]], bounds[part[:, 0] + 1]
            # a window that would leave its text is moved inside; short texts end in word 0
            start = np.maximum(np.minimum(part[:, 2], stop - size), begin)
            at = start[:, None] + np.arange(size)
            block = np.where(at < stop[:, None], words[np.minimum(at, len(words) - 1)], np.uint64(0))
            keys = cgk_keys(block, items.tables).tolist()
            for k, row_keys in enumerate(keys):
                met = {i for t, key in enumerate(row_keys) for i in items.keys[size][t].get(key, ())}
                for i in met:
                    r, spare = int(part[k, 0]), int(items.edits[i])
                    a, b = max(int(begin[k]), int(start[k]) - spare), min(int(stop[k]), int(start[k]) + size + spare)
                    best = out.get(r, {}).get(i)
                    if best is not None and best[0] == 0:
                        continue
                    distance, end = infix_distance(items.words[i], words[a:b])
                    if distance <= spare and (best is None or distance < best[0]):
                        out.setdefault(r, {})[i] = (distance, max(0, a + end - size - int(begin[k])))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, recall: float = RECALL) -> DataFrame:
    """``docs`` plus ``leaks``: array of (item_id, distance, item_words, first_word),
    one per leaked item, by item_id (a column of that name is replaced; others are carried along).

    Words are runs of letters and digits, A-Z lower-cased, so punctuation, spacing
    and ASCII case do not matter; each character of a script written without
    blanks (Chinese, Japanese, Thai and the like) is a word. ``distance``
    counts words; it is the least found. Items of under 1 / ``max_edit`` words must
    stand unchanged. Every leak is found with probability ``recall`` at the largest
    distance, more below; an unchanged one always. No clean document is flagged:
    every leak is verified exactly.

    Null and empty texts have no leaks; items without words leak nowhere;
    repeated items count once; an empty table on either side gives empty lists.
    Repeated rows stay. Very long texts are searched whole.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    out = docs.withColumn("leaks", F.array().cast(LEAKS))
    for number in range(blocks):
        if number:
            out = saved(out, "leaks")  # one pass, and one block in a task's memory, at a time
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).orderBy("item_id", "text").collect()
        sent = spark.sparkContext.broadcast(prepared([(r[0], r[1]) for r in mine], max_edit, tables_for(recall)))
        (new,) = unused(out, "found")
        whole = StructType([*out.schema.fields, StructField(new, out.schema["leaks"].dataType)])
        arrow = to_arrow_schema(whole)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, arrow=arrow) -> Iterator[pa.RecordBatch]:
            ready = sent.value
            for batch in batches:
                for rows, data, offsets in chunks(batch, "text"):
                    row, start, end = word_spans(data, offsets, letters_only=True)
                    words = word_hashes(data, start, end, lower=True)
                    got = leaks_of(words, row, rows.num_rows, ready)
                    cells = [
                        [
                            {"item_id": ready.ids[i], "distance": d, "item_words": len(ready.words[i]), "first_word": f}
                            for i, (d, f) in sorted(got.get(k, {}).items())
                        ]
                        for k in range(rows.num_rows)
                    ]
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cells, arrow.field(len(arrow) - 1).type)], names=arrow.names)

        out = out.mapInArrow(run, whole).withColumn("leaks", F.concat("leaks", new)).drop(new)
    return out.withColumn("leaks", F.array_sort("leaks"))
