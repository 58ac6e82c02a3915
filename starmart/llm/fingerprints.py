"""Quartile bucket digests of whole documents.

Byte triplets (a byte and two later ones at fixed distances, cyclic over the
text) are hashed into buckets and counted. Each bucket's count is encoded by the
quartile of all buckets it falls in, two bits per bucket, after one byte for the
logarithm of the length. Two digests are compared by a bounded difference.
The distances reach beyond a word, so the counts tell texts of one language
apart instead of its frequent syllables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import saved

BUCKETS = 512
#: Distances of the second and third byte of a triplet from the first.
DISTANCES = ((3, 6), (4, 8), (5, 10))
#: Mean weighted bucket difference at which likeness is 0: a little under that of unrelated texts.
FAR = 1.7
#: Weight of a difference of 0, 1, 2 or 3 quartiles.
WEIGHTS = (0.0, 1.0, 2.0, 6.0)
#: Likeness lost per doubling of the length.
LENGTH_COST = 0.05
PIECE = 1 << 20


def digest(raw: np.ndarray) -> np.ndarray:
    """The digest of UTF-8 bytes: one byte of length, then a code 0 to 3 per bucket (uint8)."""
    n = len(raw)
    counts = np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    reach = max(j for _, j in DISTANCES)
    for at in range(0, n, PIECE):  # long texts in pieces, so memory is bounded
        m = min(PIECE, n - at)
        x = raw[at : at + m + reach]
        while len(x) < m + reach:
            x = np.concatenate([x, raw[: m + reach - len(x)]])
        x = x.astype(np.uint32)
        for i, j in DISTANCES:
            h = x[:m] | (x[i : i + m] << np.uint32(8)) | (x[j : j + m] << np.uint32(16))
            h = (h + np.uint32(i * 7919 + j * 104729)) * np.uint32(2654435769)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822507)
            counts += np.bincount(h >> shift, minlength=BUCKETS)
    q = np.partition(counts, (BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1))
    codes = sum((counts > q[k * BUCKETS // 4 - 1]).astype(np.uint8) for k in (1, 2, 3))
    return np.concatenate([[np.uint8(min(255, round(8 * np.log2(1 + n))))], codes])


def digest_text(code: np.ndarray) -> str:
    """A digest as lowercase hex: the length byte, then four buckets per byte."""
    four = code[1:].reshape(-1, 4)
    packed = four[:, 0] | (four[:, 1] << 2) | (four[:, 2] << 4) | (four[:, 3] << 6)
    return bytes([int(code[0])]).hex() + packed.astype(np.uint8).tobytes().hex()


def digest_codes(text: str) -> np.ndarray:
    """The inverse of ``digest_text``."""
    packed = np.frombuffer(bytes.fromhex(text), np.uint8)
    return np.concatenate([packed[:1], ((packed[1:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3).ravel()])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 minus the bounded difference of two digests: 1 for equal ones, never below 0."""
    apart = np.abs(a[1:].astype(np.int8) - b[1:].astype(np.int8))
    buckets = float(np.array(WEIGHTS)[apart].mean()) / FAR
    length = abs(int(a[0]) - int(b[0])) / 8 * LENGTH_COST
    return max(0.0, 1.0 - buckets - length)


def fingerprint(text: Column) -> Column:
    """The digest of each text (null counts as empty), Arrow batch by batch."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([digest_text(digest(np.frombuffer((t or "").encode(), np.uint8))) for t in texts])

    return run(text)


def fingerprint_likeness(a: Column, b: Column) -> Column:
    """Likeness of two digest columns; null where either is null."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else likeness(digest_codes(p), digest_codes(q)) for p, q in zip(x, y)], dtype="float64")

    return run(a, b)


EDITED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(text: str, code: np.ndarray, other: str, other_code: np.ndarray) -> tuple:
    import hashlib

    cut = len(text) // 3
    edited = (text[: len(text) - cut] + other[:cut]).encode()
    changed = digest(np.frombuffer(edited, np.uint8))
    return (len(text), hashlib.sha256(edited).hexdigest(), digest_text(code), digest_text(changed), likeness(code, changed), likeness(code, other_code))


def _coded(text: str) -> np.ndarray:
    return digest(np.frombuffer(text.encode(), np.uint8))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document's.

    ``docs`` (doc_id, text; others are ignored). The next document is that of the
    next smaller doc_id, after the smallest that of the largest; null doc_ids come
    last. Of several rows with one doc_id the least text stands for it as next.
    The edited text has its last third of code points replaced by the first as
    many of the next document. Null texts count as empty. Repeated rows stay.

    One range shuffle brings documents in doc_id order; a task walks its range
    upwards and remembers one text. Only rows with the smallest doc_id of a
    range need the range before: they are written with their text, with one
    closing text per range, and joined in a second, small step.
    """
    ranged = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    ranged = ranged.repartitionByRange(order[0]).sortWithinPartitions(*order)
    key = docs.schema["doc_id"].dataType
    base = StructType([StructField("doc_id", key)])
    result = StructType(base.fields + StructType.fromDDL(EDITED).fields)
    step = StructType(result.fields + [StructField("part", StructType.fromDDL("x int")["x"].dataType), StructField("state", StringType()), StructField("text", StringType())])
    none = (None,) * 6

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, part = to_arrow_schema(step), TaskContext.get().partitionId()
        seen, now, text, code, before, before_code = False, None, "", None, None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = []
                ids, texts = batch.column(0).slice(lo, 256), batch.column(1).slice(lo, 256)
                for i, t in zip(ids.to_pylist(), texts.to_pylist()):
                    own = _coded(t)
                    if not seen or i != now:
                        if seen:
                            before, before_code = text, code
                        seen, now, text, code = True, i, t, own
                    rows.append((i, *none, part, "first", t) if before is None else (i, *_compared(t, own, before, before_code), part, "done", None))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
        if seen:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (now, *none, part, "close", text)))], schema=schema)

    walked = saved(ranged.mapInArrow(walk, step), "fingerprint-ranges")
    closing = walked.where("state = 'close'").select("part", "text")
    # one row per range; only their numbers are ordered
    from pyspark.sql import Window

    ranges = closing.select("part").withColumns(
        {"previous": F.lag("part").over(Window.orderBy("part")), "last": F.max("part").over(Window.partitionBy())}
    )
    ranges = ranges.select("part", F.coalesce("previous", "last").alias("from"))
    open_rows = (
        walked.where("state = 'first'")
        .select("doc_id", "text", "part")
        .join(ranges, "part")
        .join(closing.select(F.col("part").alias("from"), F.col("text").alias("other")), "from")
        .select("doc_id", "text", "other")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(result)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = [batch.column(k).slice(lo, 256).to_pylist() for k in range(3)]
                rows = [(i, *_compared(t, _coded(t), o, _coded(o))) for i, t, o in zip(*part)]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    return walked.where("state = 'done'").select(*result.names).unionByName(open_rows.mapInArrow(finish, result))
