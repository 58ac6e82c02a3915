"""Substring dedup: repeated word windows found level by level.

Windows of a short length are looked at first. Only where windows repeat across
documents are they extended, to twice the length each time and at last to the
wanted length, until that is reached or no candidate survives. The first level
is sampled: every window of the next length is judged by the least hash among
the short windows in it, which equal windows share, so nothing is lost. What
repeats on a level is handed to the next as a bitmap of fixed size; a wrong
"maybe" costs work, never a result, since the last level is matched exactly on
two 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, in_bitmap, join_groups, saved
from .textwords import chunks, row_bounds, window_hashes, word_hashes, word_spans

#: Words of a removed window.
WINDOW = 13
#: Bits of the bitmaps handed from level to level (2**26 bits: 8 MB).
LOG_BITS = 26
LAST = (1 << 63) - 1


def level_lengths(window: int) -> list[int]:
    """Window lengths of the levels: each at most twice the one before."""
    out = [window]
    while out[0] > 8:
        out.insert(0, -(-out[0] // 2))
    return out if len(out) > 1 else [max(1, -(-window // 2)), window]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row, start, end = word_spans(data, offsets)
    return row, word_hashes(data, start, end)


def _inside(row: np.ndarray, length: int) -> np.ndarray:
    """Which windows of ``length`` words lie in one row."""
    return row[: len(row) - length + 1] == row[length - 1 :]


def anchors(row: np.ndarray, words: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(valid, anchor) of each window of the second length: its least first-level hash."""
    if len(words) < lengths[1]:
        return np.zeros(0, bool), np.zeros(0, np.uint64)
    return _inside(row, lengths[1]), _sliding_min(window_hashes(words, lengths[0]), lengths[1] - lengths[0] + 1)


def surviving(row: np.ndarray, words: np.ndarray, lengths: list[int], found: list[np.ndarray]) -> np.ndarray:
    """Starts of the windows of length ``lengths[len(found)]`` whose parts repeat on
    every level before. ``found``: bitmaps of the levels so far."""
    valid, anchor = anchors(row, words, lengths)
    alive = valid & in_bitmap(found[0], anchor) if len(anchor) else valid
    for level in range(1, len(found)):
        alive = alive & in_bitmap(found[level], window_hashes(words, lengths[level])) if len(alive) else alive
        step = lengths[level + 1] - lengths[level]
        alive = alive[:-step] & alive[step:] if len(alive) > step else np.zeros(0, bool)
    if len(alive):
        alive = alive & _inside(row, lengths[len(found)])
    return np.flatnonzero(alive)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with order number (null doc_id last), text hashes and a tag of row identity."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("at"), text.alias("text"))
    keyed = keyed.withColumns({"body": F.xxhash64("text"), "check": F.xxhash64(F.lit(7), F.col("text"))})
    return keyed.withColumn("tag", F.xxhash64("at", "body"))


def repeated_words(docs: DataFrame, window: int = WINDOW, log_bits: int = LOG_BITS) -> DataFrame:
    """(at, body, whole, starts): windows to remove, one row per affected document.

    ``at`` is doc_id (null: the largest long), ``body`` the text's hash. ``whole``:
    an equal text has a smaller doc_id, so every window goes. Else ``starts`` lists
    the first words of windows that also start in a document with a smaller
    doc_id. Copies take no further part: of a group of equal texts only rows of
    the smallest doc_id are cut into windows.
    """
    keyed = _keyed(docs)
    spark = docs.sparkSession
    lengths = level_lengths(window)
    ids = saved(keyed.select("at", "body", "check", "tag"), "passage-ids")
    groups = ids.groupBy("body", "check").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    judged = join_groups(ids, groups, ["body", "check"], "left").withColumn("copy", F.coalesce(F.col("at") > F.col("first"), F.lit(False)))
    judged = saved(judged.select("at", "body", "tag", "copy"), "passage-copies")
    firsts = spark.sparkContext.broadcast(bitmap(judged.where("not copy"), F.col("tag"), log_bits))
    found: list = []
    texts = keyed.select("at", "body", "tag", "text")

    def of_firsts(batch):
        keep = in_bitmap(firsts.value, batch.column("tag").to_numpy().view(np.uint64))
        return batch.filter(pa.array(keep))

    def hashes(level):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, data, offsets in chunks(of_firsts(batch), "text"):
                    row, words = _words(data, offsets)
                    if level == 0:
                        valid, value = anchors(row, words, lengths)
                        row, value = row[: len(value)][valid], value[valid]
                    else:
                        start = surviving(row, words, lengths, [b.value for b in found])
                        row, value = row[start], window_hashes(words, lengths[level])[start] if len(start) else words[:0]
                    bounds = row_bounds(row, len(offsets) - 1)
                    parts = [np.unique(value[a:b]) for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
                    out = np.concatenate(parts) if parts else value[:0]
                    yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["h"])

        return run

    for level in range(len(lengths) - 1):
        counted = texts.select("tag", "text").mapInArrow(hashes(level), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        found.append(spark.sparkContext.broadcast(bitmap(counted, F.col("h"), log_bits)))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(of_firsts(batch), "text"):
                row, words = _words(data, offsets)
                start = surviving(row, words, lengths, [b.value for b in found])
                one = window_hashes(words, window)[start] if len(start) else words[:0]
                two = window_hashes(words, window, seed=1)[start] if len(start) else words[:0]
                of = row[start]
                begin = row_bounds(row, rows.num_rows)
                columns = [pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
                columns += [rows.column(c).take(pa.array(of)) for c in ("at", "body")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array((start - begin[of]).astype(np.int32))], names=["h1", "h2", "at", "body", "start"])

    rows = saved(texts.mapInArrow(windows, "h1 long, h2 long, at long, body long, start int"), "passage-windows")
    least = rows.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n")).where("first < last").drop("last")
    later = join_groups(rows, least, ["h1", "h2"]).where("at > first")
    starts = later.groupBy("at", "body").agg(F.collect_set("start").alias("starts")).select("at", "body", F.lit(False).alias("whole"), "starts")
    whole = judged.where("copy").select("at", "body", F.lit(True).alias("whole"), F.lit(None).cast("array<int>").alias("starts")).distinct()
    return starts.unionByName(whole)


def _cut(words: int, at: np.ndarray | None, whole: bool, window: int, data, start, end) -> tuple[int, bytes]:
    """(words removed, kept words joined by blanks) of one text."""
    gone = np.zeros(words + 1, np.int64)
    if whole and words >= window:
        gone[0], gone[words] = 1, -1
    elif at is not None and len(at):
        np.add.at(gone, at, 1)
        np.add.at(gone, at + window, -1)
    keep = np.cumsum(gone[:words]) == 0
    return int(words - keep.sum()), b" ".join(data[a:b].tobytes() for a, b in zip(start[keep], end[keep]))


def remove_repeats(docs: DataFrame, window: int = WINDOW, log_bits: int = LOG_BITS, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept of every row of ``docs`` (doc_id, text).

    A word goes if a window of ``window`` consecutive words covers it whose words
    also stand in a document with a smaller doc_id (nulls count as largest).
    ``kept`` is the remaining words joined by one blank, with ``digest`` its SHA-256.

    Null texts count as empty; texts shorter than a window keep all. Rows with
    one doc_id do not remove from each other. Repeated rows stay, each judged
    alike. Other columns are ignored. An empty table gives an empty result.

    Documents that no window was found in are finished where they are read;
    only the others' texts are shuffled to meet their windows.
    """
    import hashlib

    spans = saved(repeated_words(docs, window, log_bits), "passage-spans")
    touched = docs.sparkSession.sparkContext.broadcast(bitmap(spans, F.xxhash64("at", "body"), log_bits))

    def result(kept: bytes) -> str:
        return hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "replace")

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch, "text"):
                maybe = in_bitmap(touched.value, rows.column("tag").to_numpy().view(np.uint64))
                row, start, end = word_spans(data, offsets)
                bounds = row_bounds(row, rows.num_rows)
                kept = [
                    None if m else result(b" ".join(data[x:y].tobytes() for x, y in zip(start[a:b].tolist(), end[a:b].tolist())))
                    for m, a, b in zip(maybe, bounds[:-1], bounds[1:])
                ]
                text = [t if m else None for m, t in zip(maybe, rows.column("text").to_pylist())]
                columns = [rows.column("at"), rows.column("body"), pa.array(np.diff(bounds)), pa.array(kept, pa.string()), pa.array(text, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "body", "n_words", "kept", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch, "text"):
                row, start, end = word_spans(data, offsets)
                bounds = row_bounds(row, rows.num_rows)
                whole, starts = rows.column("whole").to_pylist(), rows.column("starts")
                got = []
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    at = starts[k].values.to_numpy() if starts[k].is_valid else None
                    got.append(_cut(int(b - a), at, bool(whole[k]), window, data, start[a:b], end[a:b]))
                columns = [rows.column("at"), pa.array(np.diff(bounds)), pa.array([g[0] for g in got], pa.int64()), pa.array([result(g[1]) for g in got], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "n_words", "n_removed", "kept"])

    keyed = _keyed(docs).select("at", "body", "tag", "text")
    first = saved(keyed.mapInArrow(untouched, "at long, body long, n_words long, kept string, text string"), "passage-texts")
    done = first.where("text is null").select("at", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept")
    rest = first.where("text is not null").select("at", "body", "text").join(spans, ["at", "body"], "left")
    out = done.unionByName(rest.mapInArrow(cut, "at long, n_words long, n_removed long, kept string"))
    return out.select(F.when(F.col("at") != LAST, F.col("at")).alias("doc_id"), "n_words", "n_removed", "kept")
