"""Packing, collocations and spelling variants against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import phrases, variants
from starmart.llm.packing import Encoder, pack_documents, pack_lot
from starmart.llm.queries_vocabulary import read_vocabulary

# names that the operators use inside, as extra columns of the input
SCHEMA = "doc_id long, text string, lang string, part int, ids string, phrase string, word string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", "x", "x", "x") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary()


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    from tokenizers import Tokenizer

    out = Tokenizer.from_str(vocabulary)
    out.encode_special_tokens = True
    return out


ODD_TEXTS = [
    None, "", " ", "\n", "a", "a  b", "a\n\nB c", "x.\nThe end.\n\nThe  start", "don't we'll 'sx", "Élan über naïve façade", "汉字和かな mixed 漢 字",
    "tab\tand space em", "a" * 5000, "1234 5a 6 b7", "...A !B\n C", "🙂 smile🙂d", "<|endoftext|> x<|endoftext|>", "   lead", "trail   ", "　x 　 y",
]


def mixed_rows(seed=3):
    rng = random.Random(seed)
    rows = [(k, t, "en") for k, t in enumerate(ODD_TEXTS)]
    rows += [(100 + k, " ".join(rng.choice(["the", "of", "Packing,", "window.", "été"]) for _ in range(rng.randrange(1, 1500))), "en") for k in range(80)]
    return rows + [(None, "no id", "en"), (None, "no id", "en"), (100, "an id again", "en"), (7, rows[7][1], "en"), (500, "long text, of words; " * 30000, "fr")]


def test_encoder_gives_the_tokenizers_ids(vocabulary, tokenizer):
    rng = random.Random(1)
    texts = [t or "" for t in ODD_TEXTS] + ["".join(rng.choice("ab AZ.,'\n\t é漢1 ") for _ in range(rng.randrange(80))) for _ in range(4000)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    ids, counts = Encoder(vocabulary).encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_pack_lot_fills_windows_with_whole_pieces_first():
    windows, rest = pack_lot([100, 28, 60], (64, 128))
    assert windows == [(128, [(0, 0, 100), (1, 0, 28)])] and rest == [(2, 0, 60)]
    rng = random.Random(2)
    for _ in range(50):
        lengths = [rng.randrange(1, 1025) for _ in range(rng.randrange(1, 60))]
        windows, rest = pack_lot(lengths, (128, 256, 512, 1024))
        assert all(sum(p[2] for p in pieces) == tier for tier, pieces in windows)
        found = defaultdict(list)
        for piece, start, length in [p for _, pieces in windows for p in pieces] + rest:
            found[piece].append((start, length))
        for piece, length in enumerate(lengths):
            at = 0
            for start, size in sorted(found[piece]):
                assert start == at and size > 0
                at += size
            assert at == length


def test_packing_is_an_exact_round_trip(spark, vocabulary, tokenizer):
    rows = mixed_rows()
    got = pack_documents(frame(spark, rows).repartition(3), vocabulary, step_tokens=4096).collect()
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        documents[r.document].append((r.start, ids, r.doc_id, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length, r.window, r.step, r.cost))
    rebuilt = []
    for pieces in documents.values():
        pieces.sort()
        ids = [i for p in pieces for i in p[1]]
        assert [p[0] for p in pieces] == np.cumsum([0] + [len(p[1]) for p in pieces])[:-1].tolist() and len(ids) == pieces[0][3]
        rebuilt.append((pieces[0][2], ids))
    want = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t, _ in rows]
    assert sorted(rebuilt, key=repr) == sorted(want, key=repr)

    short, steps = 0, defaultdict(lambda: [0, 0])
    for pieces in sequences.values():
        pieces.sort()
        total = sum(p[1] for p in pieces)
        assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces])[:-1].tolist()
        assert len({p[2:] for p in pieces}) == 1 and pieces[0][4] == sum(p[1] ** 2 for p in pieces)
        short += total < pieces[0][2]
        steps[pieces[0][2], pieces[0][3]][0] += 1
        steps[pieces[0][2], pieces[0][3]][1] += pieces[0][4]
    assert short <= 3  # the last window of a partition
    for window in {w for w, _ in steps}:
        groups = [v for (w, _), v in sorted(steps.items()) if w == window]
        assert sorted(s for w, s in steps if w == window) == list(range(len(groups)))
        assert max(g[0] for g in groups) <= 4096 // window and max(g[0] for g in groups) - min(g[0] for g in groups) <= 1


def test_step_groups_have_even_cost(spark, vocabulary):
    rng = random.Random(4)
    rows = [(k, "word " * rng.choice([30, 200, 700, 3000]), "en") for k in range(600)]
    out = pack_documents(frame(spark, rows).repartition(4), vocabulary, step_tokens=16384)
    costs = out.where("offset = 0 and window = 1024").groupBy("step").agg(F.avg("cost").alias("c"), F.count("*").alias("n")).collect()
    assert len(costs) > 10 and max(r.c for r in costs) < 1.25 * min(r.c for r in costs)


def test_packing_of_nothing(spark, vocabulary):
    out = pack_documents(frame(spark, []), vocabulary)
    assert out.count() == 0 and "ids" in out.columns
    assert [r.length for r in pack_documents(frame(spark, [(1, None, "en")]), vocabulary).collect()] == [1]
    with pytest.raises(ValueError, match="ascending"):
        pack_documents(frame(spark, []), vocabulary, tiers=(256, 128))


# -- collocations --------------------------------------------------------------


def plain_counts(rows, longest=4):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                counts[lang].update(" ".join(w[i : i + n]) for i in range(len(w) - n + 1))
    return counts, total


def plain_collocations(rows, least, top):
    counts, total = plain_counts(rows)
    out = []
    for lang, f in counts.items():
        f = {p: n for p, n in f.items() if n >= least}
        scored = []
        for p, a in f.items():
            w = p.split(" ")
            if len(w) < 2 or any(f" {p} " in f" {q} " and len(q.split(" ")) > len(w) and 100 * n >= 80 * a for q, n in f.items()):
                continue
            cuts = [(2000000 * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def phrase_rows():
    rng = random.Random(6)
    vocabulary = ["New", "york", "the", "of", "a", "être", "x\x00y", "in"]
    rows = []
    for k in range(150):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 9))) for _ in range(rng.randrange(1, 6))]
        rows.append((k, rng.choice([". ", ",", "\n", "; \t"]).join(parts), rng.choice(["en", "en", "fr", None])))
    rows += [(900, "a a a a a a " * 30, "en"), (901, "new york in the " * 2000, "fr"), (None, "of the of the", None), (None, "of the of the", None)]
    return rows + [(902, None, "en"), (903, "", None), (904, " .,; ", "en"), (905, "rare only", "de")]


@pytest.mark.parametrize("shard, bits", [(6 << 20, 27), (2000, 27), (2000, 4)])
def test_collocations_equal_a_plain_count(spark, monkeypatch, shard, bits):
    """Also over many shards, and with bitmaps so small that all their bits are set."""
    monkeypatch.setattr(phrases, "SHARD_BYTES", shard)
    monkeypatch.setattr(phrases, "may_be", phrases.may_be if bits > 16 else lambda df, key: phrases.bitmap(df, F.col(key), 6) | np.uint64(2**64 - 1))
    rows = phrase_rows()
    got = phrases.collocations(frame(spark, rows).repartition(3), least=5, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, 5, 40)


def test_two_way_index_counts_every_phrase():
    rng = np.random.default_rng(7)
    for size in (1, 5, 60, 400):
        seq = np.concatenate([[0], rng.integers(0, 5, size) * (rng.random(size) < 0.9), [0]]).astype(np.int64)
        index = phrases.TwoWayIndex(seq, 4)
        spans = index.words()
        for n in range(1, 5):
            if n > 1:
                spans = index.extend(*spans)
            want = Counter(t for t in (tuple(seq[i : i + n].tolist()) for i in range(len(seq) - n + 1)) if 0 not in t)
            texts = index.phrases(spans[0], n) if len(spans[0]) else np.zeros((0, n))
            assert {tuple(t): c for t, c in zip(texts.tolist(), spans[2].tolist())} == dict(want)


def test_collocation_arithmetic_passes_64_bits(spark, monkeypatch):
    many = 9 * 10**17
    counts = spark.createDataFrame([("en", "b c", 2, many), ("en", "b", 1, many + 5), ("en", "c", 1, many + 10**17)], "lang string, phrase string, size int, n long")
    words = spark.createDataFrame([("en", 2 * many)], "lang string, n long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: (counts, words))
    row = phrases.collocations(frame(spark, [])).collect()[0]
    assert (row.a, row.score) == (many, 2000000 * many // (2 * many + 5 + 10**17))


def test_collocations_of_nothing(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, "en"), (2, "one two", "en")])).count() == 0


# -- spelling variants ---------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, times=10):
    out, form = [], {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def plain_words(rows):
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_near_in_list_equals_all_pairs():
    rng = random.Random(8)
    for _ in range(200):
        words = sorted({"".join(rng.choices("abc"[: rng.choice([2, 3])], k=rng.randrange(1, 8))) for _ in range(rng.randrange(1, 70))})
        want = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])]
        assert sorted(variants.near_in_list(words)) == want


def variant_words():
    rng = random.Random(9)
    words = {"".join(rng.choices("ab", k=rng.randrange(7, 12))): rng.randrange(2, 5000) for _ in range(300)}
    # a third of the words share all but two letters
    words |= {"serials" + x + y + "ending": rng.randrange(2, 40) for x in "abcdefghijkl" for y in "mnopqrstuvw"}
    words |= {"chained": 2, "chainedd": 25, "chaineddd": 300, "chainedddd": 3000, "éclairé": 5, "eclairé": 60, "x" * 3000: 3, "x" * 3001: 31}
    return words


@pytest.mark.parametrize("most", [2048, 40, 2])
def test_variants_equal_a_plain_search(spark, monkeypatch, most):
    """With groups split down to one letter as well."""
    monkeypatch.setattr(variants.grouped, "__defaults__", (most,))
    words = variant_words()
    frame_ = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    rows = variants.grouped(frame_).groupBy("key", "small", "head", "tail").agg(F.count("*").alias("n"))
    assert rows.where((F.col("n") > most) & (F.col("small") - F.col("head") - F.col("tail") > 1)).count() == 0
    got = variants.variant_groups(frame_)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == plain_variants(words)


def test_spelling_variants_of_texts(spark):
    rng = random.Random(10)
    base = ["international", "packaging", "Collocation", "défenseurs", "vocabulary", "short", "spelling", "spellings"]
    rows = [(rng.choice([None, *range(60)]), " ".join(rng.choices(base, k=rng.randrange(0, 90))) + rng.choice(["", ".", "×÷xyz"]), "en") for _ in range(150)]
    rows += [(1, None, "en"), (2, "", "en"), (3, "internatiönal " * 3, "en"), (4, "packaging" * 5000, "en"), (4, "packaging" * 5000, "en")]
    got = variants.spelling_variants(frame(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == plain_variants(plain_words(rows))


def test_variants_of_nothing(spark):
    assert variants.spelling_variants(frame(spark, [])).count() == 0
    assert variants.spelling_variants(frame(spark, [(1, "one two", "en"), (2, None, "en")])).count() == 0
