"""Language identification of whole, possibly mixed texts.

Script ranges narrow each word's candidate languages, hashed character triples
score the word under each candidate, and Viterbi with a penalty for every switch
labels the word sequence. Counts are learned from all training documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .textwords import chunks, row_bounds

LOG_BUCKETS = 14
#: Text bytes scored at once.
CHUNK_BYTES = 1 << 19
#: Log-likelihood a path must gain to change language once.
SWITCH = 12.0
#: A language is a candidate for words in scripts that hold this share of its letters.
SCRIPT_SHARE = 0.01
#: Languages of a model at most; more are refused, since the model is sent to every task.
MOST_LANGUAGES = 512
UNKNOWN = "und"

# First and last code point of letter ranges, with script number
# (0 is none, 1 Latin, 2 Greek, 3 Cyrillic, 4 Armenian, 5 Hebrew, 6 Arabic,
# 7 Indic, 8 Thai and Lao, 9 Georgian, 10 Hangul, 11 Ethiopic, 12 Khmer, 13 kana, 14 Han;
# 15 are the letters outside these ranges).
SCRIPTS = [
    (0x41, 0x5A, 1), (0x61, 0x7A, 1), (0xAA, 0xAA, 1), (0xBA, 0xBA, 1), (0xC0, 0xD6, 1), (0xD8, 0xF6, 1), (0xF8, 0x2AF, 1),
    (0x370, 0x3FF, 2), (0x400, 0x52F, 3), (0x531, 0x587, 4), (0x5D0, 0x5F2, 5), (0x620, 0x6FF, 6), (0x750, 0x77F, 6),
    (0x900, 0xDFF, 7), (0xE01, 0xEFF, 8), (0x10A0, 0x10FF, 9), (0x1100, 0x11FF, 10), (0x1200, 0x139F, 11), (0x1780, 0x17FF, 12),
    (0x1E00, 0x1EFF, 1), (0x1F00, 0x1FFF, 2), (0x3041, 0x30FF, 13), (0x3130, 0x318F, 10), (0x3400, 0x9FFF, 14), (0xAC00, 0xD7AF, 10),
    (0xF900, 0xFAFF, 14), (0xFF21, 0xFF5A, 1), (0x20000, 0x323AF, 14),
]
N_SCRIPTS = 16


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's code points (A-Z and Latin-1 capitals lower-cased) and row offsets."""
    cps = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).copy()
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    if starts[-1] != len(cps):  # broken UTF-8: count row by row
        parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        cps = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).copy()
        at = np.cumsum([0, *map(len, parts)])
    else:
        at = starts[offsets]
    capital = ((cps >= 65) & (cps <= 90)) | ((cps >= 0xC0) & (cps <= 0xDE) & (cps != 0xD7))
    cps[capital] += 32
    return cps, at


def scripts_of(cps: np.ndarray) -> np.ndarray:
    """Script number of each code point; 0 for what is no letter."""
    first = np.array([a for a, _, _ in SCRIPTS], np.uint32)
    last = np.array([b for _, b, _ in SCRIPTS], np.uint32)
    number = np.array([s for _, _, s in SCRIPTS], np.uint8)
    out = np.zeros(len(cps), np.uint8)
    out[(cps >= 97) & (cps <= 122)] = 1
    rest = np.flatnonzero(cps > 122)
    k = np.searchsorted(first, cps[rest], "right") - 1
    out[rest] = np.where(cps[rest] <= last[k], number[k], 0)
    rest = rest[out[rest] == 0]
    kinds, which = np.unique(cps[rest], return_inverse=True)
    out[rest] = np.array([(N_SCRIPTS - 1) * chr(c).isalpha() for c in kinds.tolist()], np.uint8)[which]
    return out


def words_of(cps: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal runs without ASCII white space."""
    word = (cps > 32) | (cps < 9) | ((cps > 13) & (cps < 32))
    if not len(word):
        return (np.zeros(0, np.int64),) * 3
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = at[(at > 0) & (at < len(word))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(at, start, "right") - 1, start, end


def triple_buckets(cps: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Bucket of the triple around each position; what is no letter counts as a blank."""
    x = np.where(letters > 0, cps, 32).astype(np.uint64)
    pad = np.concatenate([[np.uint64(32)], x, [np.uint64(32)]])
    h = (pad[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (pad[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (pad[2:] * np.uint64(0x165667B19E3779F9))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - LOG_BUCKETS)).astype(np.int64)


@dataclass
class Model:
    """Log-probabilities (languages x buckets) and script candidates (languages x scripts)."""

    languages: list[str]
    logs: np.ndarray
    candidate: np.ndarray


def language_counts(docs: DataFrame) -> DataFrame:
    """(lang, kind, bucket, n) over all rows with a language: kind 0 counts triples
    around letters, kind 1 letters per script. Each task adds up its rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for rows, data, offsets in chunks(batch, "text", CHUNK_BYTES):
                cps, at = code_points(data, offsets)
                letters = scripts_of(cps)
                buckets = triple_buckets(cps, letters)
                for k, lang in enumerate(rows.column("lang").to_pylist()):
                    a, b = at[k], at[k + 1]
                    mine = letters[a:b]
                    triples, script = sums.setdefault(lang, (np.zeros(1 << LOG_BUCKETS, np.int64), np.zeros(N_SCRIPTS, np.int64)))
                    triples += np.bincount(buckets[a:b][mine > 0], minlength=1 << LOG_BUCKETS)
                    script += np.bincount(mine, minlength=N_SCRIPTS)
        for lang, both in sums.items():
            for kind, counts in enumerate(both):
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), pa.array(np.full(len(some), kind, np.int32)), pa.array(some.astype(np.int32)), pa.array(counts[some])],
                    names=["lang", "kind", "bucket", "n"],
                )

    counted = docs.where(F.col("lang").isNotNull()).select("lang", "text").mapInArrow(run, "lang string, kind int, bucket int, n long")
    return counted.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> Model:
    """Learn from all rows of ``docs`` (text, lang) with a language. The counts that
    reach the driver are bounded by languages times buckets."""
    languages = sorted(r[0] for r in docs.where(F.col("lang").isNotNull()).select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    got = language_counts(docs).toArrow()
    triples = np.zeros((len(languages), 1 << LOG_BUCKETS))
    scripts = np.zeros((len(languages), N_SCRIPTS))
    if got.num_rows:
        row = np.searchsorted(np.array(languages), np.array(got.column("lang").to_pylist()))
        kind, bucket, n = (got.column(c).to_numpy() for c in ("kind", "bucket", "n"))
        triples[row[kind == 0], bucket[kind == 0]] = n[kind == 0]
        scripts[row[kind == 1], bucket[kind == 1]] = n[kind == 1]
    scripts[:, 0] = 0
    logs = np.log((triples + 0.5) / (triples.sum(1, keepdims=True) + 0.5 * triples.shape[1]))
    candidate = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
    return Model(languages, logs.astype(np.float32), candidate)


def best_path(scores: np.ndarray, switch: float) -> np.ndarray:
    """Viterbi over words: the labels of largest total score less ``switch`` per change.

    If no run of words gains more than half of ``switch`` under another label than
    the best single one, that label everywhere is optimal: a path of k runs under
    other labels gains k halves at most and pays k - 1 switches or more (a single
    run over all words gains nothing). Then the walk is not needed.
    """
    n, width = scores.shape
    best = int(np.argmax(scores.sum(0)))
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    low = np.minimum(np.minimum.accumulate(np.vstack([np.zeros((1, width)), gain[:-1]]), axis=0), gain)
    if (gain - low).max() <= switch / 2:
        return np.full(n, best)
    rows = scores.tolist()  # plain floats: a step is a handful of comparisons
    value, back, own = rows[0], [], range(width)
    for row in rows[1:]:
        most = max(value)
        top, floor = value.index(most), most - switch
        back.append([k if value[k] >= floor else top for k in own])
        value = [(v if v >= floor else floor) + x for v, x in zip(value, row)]
    path = [value.index(max(value))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


def word_scores(model: Model, letters: np.ndarray, buckets: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letters, scores per language) of the chunk's words, which begin at ``start``.

    Scores are relative to the word's best language; languages that do not use
    the word's script fall out unless none does. What lies between words holds no
    letters, so sums from one start to the next are sums over words.
    """
    real = letters > 0
    size = np.add.reduceat(real, start, dtype=np.int64)
    scores = np.empty((len(start), len(model.languages)))
    for k in range(len(model.languages)):
        scores[:, k] = np.add.reduceat(np.where(real, model.logs[k][buckets], np.float32(0)), start)
    fits = model.candidate[:, np.maximum.reduceat(letters, start)].T
    some = fits.any(1)
    scores -= scores.max(1, keepdims=True)
    scores[~some] = 0
    scores[some] = np.where(fits[some], scores[some], -50.0)
    return size, scores


def label_text(languages: list[str], size: np.ndarray, scores: np.ndarray, switch: float) -> tuple[str, float, list[dict]]:
    """(language, score, spans) of one text from its words' letters and scores."""
    lettered = np.flatnonzero(size)
    if not len(lettered) or not languages:
        return UNKNOWN, 0.0, []
    scores = scores[lettered]
    path = best_path(scores, switch)
    held = np.bincount(path, size[lettered], minlength=len(languages))
    top = int(np.argmax(held))
    mine = scores[path == top].sum(0)
    lead = mine[top] - max(np.delete(mine, top), default=-40.0)
    turn = np.flatnonzero(np.diff(path)) + 1
    spans = [
        {"lang": languages[path[a]], "first": int(lettered[a]), "last": int(lettered[b - 1])}
        for a, b in zip([0, *turn], [*turn, len(path)])
    ]
    return languages[top], float(held[top] / held.sum() / (1 + np.exp(-np.clip(lead, -40, 40)))), spans


OUT = "lang_pred string, score double, spans array<struct<lang:string,first:int,last:int>>"


def label_languages(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``docs`` plus lang_pred, score and spans (columns of those names are replaced).

    ``spans``: language, first and last word (from 0) of each labelled stretch.
    ``lang_pred`` is the language whose spans hold most letters (ties: the first
    by name); ``score`` its share of the letters times how surely it beats the
    next language on them. Null texts, texts without a letter and any text under
    a model without languages get ``und``, score 0 and no spans. Very long texts
    are labelled whole. Repeated rows stay.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = docs.drop("lang_pred", "score", "spans")
    schema = StructType([*kept.schema.fields, *StructType.fromDDL(OUT).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch, "text", CHUNK_BYTES):
                cps, at = code_points(data, offsets)
                letters = scripts_of(cps)
                buckets = triple_buckets(cps, letters)
                row, start, _ = words_of(cps, at)
                bounds = row_bounds(row, rows.num_rows)
                size, scores = word_scores(model, letters, buckets, start) if len(start) and model.languages else (start, np.zeros((0, len(model.languages))))
                got = [label_text(model.languages, size[a:b], scores[a:b], switch) for a, b in zip(bounds[:-1], bounds[1:])]
                columns = [pa.array([g[k] for g in got], arrow.field(len(arrow) - 3 + k).type) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], schema=pa.schema([*rows.schema, *[arrow.field(len(arrow) - 3 + k) for k in range(3)]]))

    return kept.mapInArrow(run, schema)
