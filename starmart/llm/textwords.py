"""Words of whole texts as hashes, for many texts at once (numpy inside tasks).

A word is a maximal run of characters other than blank and tab to carriage
return. Those are single bytes in UTF-8, so words are found on the bytes. A
word's hash is a polynomial over per-byte random values, taken for all words
of a chunk through one running sum. Texts are handled in chunks of bounded
bytes, so memory does not follow the Arrow batch size.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
STEP = 1 << 18
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of ``batch`` with about ``limit`` text bytes (one row at least):
    (rows, UTF-8 bytes, offsets of the rows' texts). Null texts count as empty."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_bytes(letters_only: bool = False) -> np.ndarray:
    """Which bytes belong to words: all but blank and tab to carriage return, or
    only ASCII letters, digits and the bytes of other characters."""
    table = np.ones(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = False
    if letters_only:
        table[:128] = False
        for first, last in ((48, 58), (65, 91), (97, 123)):
            table[first:last] = True
    return table


#: Scripts written without blanks: Thai, Lao; Myanmar; Khmer; Tai scripts; kana, Bopomofo, Han; Yi; Han.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3021, 0x312F),
    (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
)


def character_kinds() -> tuple[np.ndarray, np.ndarray]:
    """Runs of code points (first, kind). Kind 0 parts words (punctuation, symbols,
    spaces, controls), 1 is part of a word, 2 is a word."""
    kinds = np.ones(0x110000, np.uint8)
    for first, last in UNSPACED:
        kinds[first : last + 1] = 2
    for cp in range(0x20000):  # further planes hold no marks
        if unicodedata.category(chr(cp)) in ("Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po", "Sm", "Sc", "Sk", "So", "Zs", "Zl", "Zp", "Cc") or cp == 0x200B:
            kinds[cp] = 0
    first = np.flatnonzero(np.diff(kinds, prepend=np.uint8(255)))
    return first, kinds[first]


#: Travels to the workers with the functions that use it; short, so any task can look it up.
KINDS = character_kinds()


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, bytes, kind) of the non-ASCII characters."""
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at].astype(np.int64)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    cp = lead & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
    for k in (1, 2, 3):
        more = size > k
        cp[more] = cp[more] << 6 | (data[np.minimum(at[more] + k, len(data) - 1)] & 0x3F)
    return at, size, KINDS[1][np.searchsorted(KINDS[0], cp, "right") - 1]


def word_spans(data: np.ndarray, offsets: np.ndarray, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every word of the chunk, in order. With ``letters_only``
    other scripts' punctuation, symbols and spaces part words as ASCII's do, and a
    character of a script written without blanks is a word."""
    word = word_bytes(letters_only)[data]
    cuts = np.zeros(0, np.int64)
    if letters_only:
        at, size, kind = characters(data)
        for k in range(4):
            word[at[(size > k) & (kind == 0)] + k] = False
        alone = kind == 2
        cuts = np.concatenate([at[alone], (at + size)[alone]])
    if not len(word):
        return (np.zeros(0, np.int64),) * 3
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = np.concatenate([offsets, cuts])
    inner = inner[(inner > 0) & (inner < len(word))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, end


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word's bytes (``lower``: A-Z count as a-z)."""
    values = mix64(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
    if lower:
        values[65:91] = values[97:123]
    out = np.empty(len(start), np.uint64)
    at, size = 0, 0
    up = down = np.zeros(0, np.uint64)
    odd = np.uint64(0xD6E8FEB86659FD93)
    inverse = np.uint64(pow(int(odd), -1, 1 << 64))
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + STEP, "right")))
        lo, hi = int(start[at]), int(end[to - 1])
        if hi - lo > size:
            size = max(STEP, hi - lo)
            up = np.full(size, odd, np.uint64)
            down = np.full(size, inverse, np.uint64)
            up[0] = down[0] = 1
            up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        s, e = start[at:to] - lo, end[at:to] - lo
        out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mix64(out)


def window_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (runs over row ends too)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words) - n + 1
    total = np.zeros(size, np.uint64)
    factor = np.uint64(2 * seed + 0xA0761D6478BD642F)
    for k in range(n):
        total *= factor
        total += words[k : k + size]
    return mix64(total + np.uint64((n + 1000 * seed) * int(MULTIPLIER) % (1 << 64)))


def row_bounds(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row's words in the chunk's word list."""
    return np.searchsorted(row, np.arange(n_rows + 1))
