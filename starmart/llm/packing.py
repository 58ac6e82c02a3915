"""Hierarchical multi-length packing of tokenised documents.

Every document becomes its ids and one closing id. Whole windows of the longest
tier are cut off first; the rest of a document is routed to the smallest tier
that holds it. Tiers are packed from the longest to the shortest: each of a
tier's pieces opens a window, and the gap it leaves is filled with the largest
whole pieces of shorter tiers that fit. Only when none fits is a piece cut, its
head closing the gap and its tail going back to the tier of its new length. So
all windows are full but the last one of an input partition, and few documents
are cut that need not be.

Windows of one tier then form step groups of equal token numbers. They are ranked
by attention cost (sum of squared piece lengths) and dealt to the groups in turn,
forwards and backwards, so group sizes differ by one window and costs are even.

Packing is done inside the partitions of the input, in lots of bounded size, so
texts are never shuffled. Only one row per window and (partition, tier, cost
class) count is needed to place windows in their groups.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small
from .textwords import chunks

#: Window lengths in tokens, each twice the one before.
TIERS = (128, 256, 512, 1024)
#: Tokens of a step group.
STEP_TOKENS = 1 << 16
#: Pieces that are packed together; bounds the memory of a task.
LOT_PIECES = 4096
#: Classes of a window's attention cost, from one piece (the dearest) down.
COST_CLASSES = 8
#: Bytes of text that are looked up at once, and the longest word kept in a worker's table of known words.
BLOCK_BYTES = 2 << 20
KNOWN_BYTES = 48
KNOWN_WORDS = 400_000

PIECE_SCHEMA = "doc_id {id}, document long, start long, length long, doc_tokens long, sequence_id long, offset long, window int, cost long, part int, cost_class int, nth long, ids binary"


class Encoder:
    """Ids of many texts at once, the same as the tokenizer gives for each text.

    The byte-level pattern always parts text before a blank that an ASCII letter
    follows, after an ASCII letter that an ASCII mark, digit or space other than an
    apostrophe follows, and before an ASCII letter after a single line feed after a
    mark or letter. Texts are cut there and each different stretch is encoded once.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}
        self.letter, self.ends, self.solid = np.zeros((3, 256), bool)
        self.letter[65:91] = self.letter[97:123] = True
        self.ends[:128] = ~self.letter[:128]
        self.ends[39] = False
        self.solid[33:127] = True

    def ids_of(self, stretches: list[bytes]) -> list[bytes]:
        """The ids of each stretch as little-endian unsigned 32-bit numbers."""
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        out = list(map(known.get, stretches))
        whole, tokenize = [], self.tokenizer.model.tokenize
        for i, ids in enumerate(out):
            if ids is None:
                stretch = stretches[i]
                blank = stretch[:1] == b" "
                if stretch[blank:].isalpha():  # ASCII letters: one word of the pattern, a blank is spelled as below
                    text = "\u0120" + stretch[1:].decode() if blank else stretch.decode()
                    out[i] = ids = array("I", [token.id for token in tokenize(text)]).tobytes()
                    if len(stretch) <= KNOWN_BYTES:
                        known[stretch] = ids
                else:
                    whole.append(i)
        for i, code in zip(whole, self.tokenizer.encode_batch_fast([stretches[i].decode() for i in whole], add_special_tokens=False)):
            out[i] = ids = array("I", code.ids).tobytes()
            if len(stretches[i]) <= KNOWN_BYTES:
                known[stretches[i]] = ids
        return out

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Before which bytes the pattern always parts."""
        safe = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            letter = self.letter[data]
            safe[:-2] = (data[:-1] == 32) & letter[1:]
            safe[1:-1] |= letter[:-1] & self.ends[data[1:]]
            safe[2:-1] |= letter[2:] & (data[1:-1] == 10) & self.solid[data[:-2]]
        return safe

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text) of the texts ``data[offsets[i]:offsets[i + 1]]``."""
        safe = self.cuts(data)
        safe[offsets] = True
        safe[-1] = True
        ids, counts, at = [], np.zeros(len(offsets) - 1, np.int64), 0
        while at < len(data):
            to = min(at + BLOCK_BYTES, len(data))
            back = np.flatnonzero(safe[at + 1 : to + 1])
            while not len(back):  # one stretch longer than a block
                to = min(to + BLOCK_BYTES, len(data))
                back = np.flatnonzero(safe[at + 1 : to + 1])
            start = np.concatenate([[0], back[:-1] + 1])
            bounds = np.append(start, back[-1] + 1).astype(np.int64)
            block = np.ascontiguousarray(data[at : at + bounds[-1]])
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(block)]).dictionary_encode()
            code = words.indices.to_numpy(zero_copy_only=False)
            values = self.ids_of(words.dictionary.to_pylist())
            size = np.fromiter(map(len, values), np.int64, len(values)) // 4
            flat = np.frombuffer(b"".join(values), np.uint32)
            first = np.cumsum(size) - size
            n = size[code]
            ids.append(flat[np.repeat(first[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
            row = np.searchsorted(offsets, start + at, "right") - 1
            np.add.at(counts, row, n)
            at += int(bounds[-1])
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), counts


def pack_lot(lengths: list[int], tiers: tuple[int, ...]) -> tuple[list[tuple[int, list[tuple[int, int, int]]]], list[tuple[int, int, int]]]:
    """Windows of pieces of the given lengths (1 to the longest tier).

    Returns (windows, rest): a window is (tier, [(piece, start, length), ...]) and
    is full; rest are the pieces of the last window if it did not fill up.
    """
    at_length: list[list[tuple[int, int]]] = [[] for _ in range(tiers[-1] + 1)]
    present = 0
    for piece, length in enumerate(lengths):
        at_length[length].append((piece, 0))
        present |= 1 << length

    def take(length: int) -> tuple[int, int]:
        nonlocal present
        piece = at_length[length].pop()
        if not at_length[length]:
            present ^= 1 << length
        return piece

    windows = []
    while present:
        longest = present.bit_length() - 1
        tier = next(t for t in tiers if t >= longest)
        piece, start = take(longest)
        window, gap = [(piece, start, longest)], tier - longest
        while gap and present:
            fits = present & ((2 << gap) - 1)
            if fits:
                length = fits.bit_length() - 1
                piece, start = take(length)
                window.append((piece, start, length))
                gap -= length
            else:
                length = (present & -present).bit_length() - 1
                piece, start = take(length)
                window.append((piece, start, gap))
                at_length[length - gap].append((piece, start + gap))
                present |= 1 << (length - gap)
                gap = 0
        if gap:
            return windows, window
        windows.append((tier, window))
    return windows, []


class Packer:
    """Packs the documents of one input partition, lot by lot."""

    def __init__(self, part: int, tiers: tuple[int, ...], schema: pa.Schema):
        self.part, self.tiers, self.schema = part, tiers, schema
        self.sequences, self.documents = 0, 0
        self.nth: dict[tuple[int, int], int] = {}
        self.waiting: list[tuple] = []  # (doc_id, document, start, ids, doc_tokens)
        self.rows: list[tuple] = []

    def window(self, tier: int, pieces: list[tuple]) -> None:
        cost = sum(len(p[3]) ** 2 for p in pieces)
        kind = min(COST_CLASSES - 1, COST_CLASSES - -(-cost * COST_CLASSES // tier**2))
        nth = self.nth.get((tier, kind), 0)
        self.nth[tier, kind] = nth + 1
        sequence, offset = (self.part << 32) + self.sequences, 0
        self.sequences += 1
        for doc_id, document, start, ids, tokens in pieces:
            self.rows.append((doc_id, document, start, len(ids), tokens, sequence, offset, tier, cost, self.part, kind, nth, ids.tobytes()))
            offset += len(ids)

    def add(self, doc_id, ids: np.ndarray) -> None:
        document, longest, n = (self.part << 32) + self.documents, self.tiers[-1], len(ids)
        self.documents += 1
        whole = n - n % longest
        for start in range(0, whole, longest):
            self.window(longest, [(doc_id, document, start, ids[start : start + longest], n)])
        if whole < n:
            self.waiting.append((doc_id, document, whole, ids[whole:].copy(), n))
            if len(self.waiting) >= LOT_PIECES:
                self.pack()

    def pack(self, last: bool = False) -> None:
        def cut(piece, start, length):
            doc_id, document, at, ids, n = self.waiting[piece]
            return doc_id, document, at + start, ids[start : start + length], n

        windows, rest = pack_lot([len(p[3]) for p in self.waiting], self.tiers)
        for tier, pieces in windows:
            self.window(tier, [cut(*p) for p in pieces])
        self.waiting = [cut(*p) for p in rest]
        if last and self.waiting:
            total = sum(len(p[3]) for p in self.waiting)
            tier = total if total in self.tiers else self.tiers[-1]
            self.window(tier, self.waiting)
            self.waiting = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in self.schema]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


def pack_documents(docs: DataFrame, tokenizer_json: str, closing_id: int = 0, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces of the packed documents of ``docs`` (doc_id, text).

    One row per piece: doc_id, document (number of its row), start and length (ids
    of the document), doc_tokens, sequence_id and offset (place of the piece), window
    (the tier's length), step (step group of that tier), cost (sum of squared piece
    lengths of the window), ids (little-endian unsigned 32-bit). A sequence shorter than
    its window, at most one per input partition, is to be padded to it.

    A null text is empty: its document is the closing id alone. A null doc_id is kept;
    rows with equal ids or texts are documents of their own. No documents give no rows.
    Other columns are ignored. Memory follows the longest single text, not the table;
    a worker holds at most ``LOT_PIECES`` rests of documents. The vocabulary is handed
    to the workers as text of fixed size, so they need no file of it.
    """
    if list(tiers) != sorted({t for t in tiers if t > 0}) or any(step_tokens % t for t in tiers):
        raise ValueError("tiers must be positive, ascending, and divide step_tokens")
    rows = docs.select("doc_id", "text", F.spark_partition_id().alias("_part"))
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(tokenizer_json)
    schema = PIECE_SCHEMA.format(id=docs.schema["doc_id"].dataType.simpleString())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = encoder = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if packer is None:
                fields = [("doc_id", batch.schema.field("doc_id").type)]
                fields += [(n, pa.int64()) for n in ("document", "start", "length", "doc_tokens", "sequence_id", "offset")]
                fields += [("window", pa.int32()), ("cost", pa.int64()), ("part", pa.int32()), ("cost_class", pa.int32()), ("nth", pa.int64()), ("ids", pa.binary())]
                packer, encoder = Packer(batch.column("_part")[0].as_py(), tiers, pa.schema(fields)), Encoder(vocabulary.value)
            for chunk, data, offsets in chunks(batch, "text"):
                ids, counts = encoder.encode(data, offsets)
                ends = np.cumsum(counts)
                for doc_id, lo, hi in zip(chunk.column("doc_id").to_pylist(), (ends - counts).tolist(), ends.tolist()):
                    packer.add(doc_id, np.append(ids[lo:hi], np.uint32(closing_id)))
                yield packer.batch()
        if packer is not None:
            packer.pack(last=True)
            yield packer.batch()

    pieces = saved(rows.mapInArrow(pack, schema), "packed-pieces")
    vocabulary.destroy()
    return step_groups(pieces, step_tokens)


def step_groups(pieces: DataFrame, step_tokens: int) -> DataFrame:
    """``pieces`` with the step group of their window.

    A window's rank within its tier (dearest cost class first, then partition) is the
    number of windows before its (class, partition) plus its place there, so no sort of
    windows is needed; counts are one row per partition, tier and class.
    """
    keys = ["window", "cost_class", "part"]
    counts = saved(pieces.where("offset = 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "packed-counts")
    before = F.sum("n").over(Window.partitionBy("window", "cost_class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # one row per tier and cost class, whatever the data
    classes = counts.groupBy("window", "cost_class").agg(F.sum("n").alias("n"))
    in_tier = Window.partitionBy("window")
    classes = classes.select(
        "window",
        "cost_class",
        F.coalesce(F.sum("n").over(in_tier.orderBy("cost_class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("dearer"),
        F.sum("n").over(in_tier).alias("all"),
    )
    places = counts.select(*keys, F.coalesce(before, F.lit(0)).alias("before")).join(F.broadcast(classes), ["window", "cost_class"])
    groups = F.expr(f"(all * window + {step_tokens - 1}) div {step_tokens}")
    places = places.select(*keys, (F.col("before") + F.col("dearer")).alias("base"), groups.alias("groups"))
    rank = F.col("base") + F.col("nth")
    at, turn = rank % F.col("groups"), F.expr("((base + nth) div groups) % 2")
    return pieces.join(small(saved(places, "packed-places")), keys).select(
        "doc_id", "document", "start", "length", "doc_tokens", "sequence_id", "offset", "window",
        F.when(turn == 0, at).otherwise(F.col("groups") - 1 - at).alias("step"), "cost", "ids",
    )
