"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a linear scorer that minimises
the non-negative unbiased risk: prior * R(positives as positive) +
max(0, R(unlabelled as negative) - prior * R(positives as negative)). The class
prior is estimated first from a scorer of positives against unlabelled text: the
smallest ratio, over score thresholds, of the unlabelled share above to the
positive share above. Features describe a whole text's style.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import saved, small
from .textwords import chunks, row_bounds, word_hashes, word_spans

#: Distinct rows of each kind (positive, unlabelled) that the fit sees at most, about:
#: chosen by hash of doc_id and text with the share bound / distinct rows.
FIT_ROWS = 20_000
#: Repeats of a word are looked for at these distances.
REPEATS = (1, 2, 3, 4, 6, 8)
CLASSES = 9


def byte_classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, blank, other space, sentence mark, bracket or quote, symbol, non-ASCII."""
    c = np.full(256, 7, np.uint8)
    c[97:123], c[65:91], c[48:58], c[128:] = 0, 1, 2, 8
    c[32] = 3
    c[[9, 10, 11, 12, 13]] = 4
    c[[ord(x) for x in ".,;:"]] = 5
    c[[ord(x) for x in "'\"()-"]] = 6
    return c


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: square roots of class-pair shares, log sizes, mean word length, repeated words."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((n, CLASSES * CLASSES + 3 + len(REPEATS)), np.float32)
    if len(data):
        kind = byte_classes()[data]
        row = np.repeat(np.arange(n), size)
        pair = kind[:-1].astype(np.int64) * CLASSES + kind[1:]
        inside = row[:-1] == row[1:]
        counts = np.bincount(row[:-1][inside] * CLASSES * CLASSES + pair[inside], minlength=n * CLASSES * CLASSES).reshape(n, -1)
        out[:, : CLASSES * CLASSES] = np.sqrt(counts / np.maximum(size - 1, 1)[:, None])
    of, start, end = word_spans(data, offsets)
    words = np.diff(row_bounds(of, n))
    hashes = word_hashes(data, start, end, lower=True)
    at = CLASSES * CLASSES
    out[:, at] = np.log1p(size) / 10
    out[:, at + 1] = np.log1p(words) / 10
    out[:, at + 2] = np.bincount(of, end - start, minlength=n) / np.maximum(words, 1) / 10 if len(of) else 0
    for k, d in enumerate(REPEATS):
        if len(of) > d:
            same = (hashes[d:] == hashes[:-d]) & (of[d:] == of[:-d])
            out[:, at + 3 + k] = np.sqrt(np.bincount(of[d:][same], minlength=n) / np.maximum(words, 1))
    return out


@dataclass
class Model:
    """A linear scorer on standardised features; ``prior`` as estimated."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(gradient, size: int, steps: int, rate: float = 0.03) -> np.ndarray:
    """Adam from zero weights (the last one is the bias)."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.3) -> float:
    """Share of positives among the unlabelled, from scores: the smallest ratio of
    the shares above a threshold, over thresholds that keep ``least`` of the positives."""
    cuts = np.quantile(positive, np.linspace(0.01, 1 - least, 60))
    above = lambda s: (s[None, :] >= cuts[:, None]).mean(1)
    return float(np.clip(np.min(above(unlabelled) / above(positive)), 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, decay: float = 1e-4) -> Model:
    """Fit on feature rows. Without positives the score is 0.5 everywhere."""
    width = positive.shape[1]
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.5)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    shape = lambda x: np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
    p, u = shape(positive), shape(unlabelled)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def contrast(w):  # positives against unlabelled, both classes with equal weight
        return -p.T @ (1 - sig(p @ w)) / len(p) + u.T @ sig(u @ w) / len(u) + decay * w

    w = _descend(contrast, width + 1, steps)
    prior = estimated_prior(p @ w, u @ w)

    def risk(w):
        ps, us = sig(p @ w), sig(u @ w)
        part = np.logaddexp(0, u @ w).mean() - prior * np.logaddexp(0, p @ w).mean()
        negative = u.T @ us / len(u) - prior * p.T @ ps / len(p)
        # below zero the step goes against the offending part, as the estimator has it
        grown = negative if part >= 0 else -negative
        return -prior * p.T @ (1 - ps) / len(p) * (part >= 0) + grown + decay * w

    w = _descend(risk, width + 1, steps)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def featured(docs: DataFrame) -> DataFrame:
    """The sample's features: (positive, hash, x). ``docs``: positive boolean, hash, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch, "text"):
                x = features(data, offsets)
                yield pa.RecordBatch.from_arrays([rows.column("positive"), rows.column("hash"), pa.array(list(x), pa.list_(pa.float32()))], names=["positive", "hash", "x"])

    return docs.select("positive", "hash", "text").mapInArrow(run, "positive boolean, hash long, x array<float>")


def chosen(rows: DataFrame, distinct: int, fit_rows: int) -> DataFrame:
    """About ``fit_rows`` of the ``distinct`` rows (doc_id, hash, text), each once."""
    if distinct > fit_rows:
        bound = max(1, (fit_rows << 63) // distinct)
        rows = rows.where(F.col("hash").bitwiseAND(F.lit((1 << 63) - 1)) < bound)
    return rows.distinct()


def train(docs: DataFrame, positives: DataFrame, trainable: Column, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on about ``fit_rows`` of the rows of ``positives`` (doc_id) and as many rows
    of any or no label, both only from rows that are ``trainable``. Rows equal in
    doc_id and text count once; of a doc_id with many texts a share is taken, as of
    all others. Only the features of that bounded sample reach the driver."""
    pool = docs.where(trainable).select("doc_id", F.xxhash64("doc_id", "text").alias("hash"), "text")
    known = small(saved(positives.select("doc_id").where("doc_id is not null").distinct(), "quality-known"))
    keys = saved(pool.select("doc_id", "hash").distinct(), "quality-keys")

    trusted = chosen(pool, keys.join(known, "doc_id", "left_semi").count(), fit_rows).join(known, "doc_id", "left_semi")
    plain = chosen(pool, keys.count(), fit_rows)
    sample = trusted.withColumn("positive", F.lit(True)).unionByName(plain.withColumn("positive", F.lit(False)))
    got = featured(sample).toArrow()
    width = CLASSES * CLASSES + 3 + len(REPEATS)
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)
    flag = got.column("positive").to_numpy(zero_copy_only=False).astype(bool)
    order = np.argsort(got.column("hash").to_numpy(), kind="stable")  # the fit does not depend on the order of arrival
    x, flag = x[order], flag[order]
    return fit(x[flag], x[~flag])


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` plus the score of each whole text (null counts as empty)."""

    from pyspark.sql.pandas.types import to_arrow_schema

    kept = docs.drop(out)
    schema = StructType([*kept.schema.fields, StructField(out, DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch, "text"):
                got = pa.array(model.score(features(data, offsets).astype(np.float64)), pa.float64())
                yield pa.RecordBatch.from_arrays([*rows.columns, got], names=arrow.names)

    return kept.mapInArrow(run, schema)
