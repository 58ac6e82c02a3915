"""The training-data operators on small inputs with nulls, ties, repeats, long and empty texts."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import decontaminate as dec
from starmart.llm import fingerprints as fp
from starmart.llm import langid, quality
from starmart.llm.jaccard import jaccard_components
from starmart.llm.line_dedup import dedup_lines
from starmart.llm import mixing
from starmart.llm.mixing import mix
from starmart.llm.passages import remove_repeats
from starmart.llm.secrets import RULES, find_secrets, span_text
from starmart.llm.textwords import window_hashes, word_hashes, word_spans
from starmart.llm.trigrams import trigram_query
from starmart.llm.url_filter import url_verdicts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, tag string"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(rng, n, width=400):
    return " ".join("".join(rng.choices(LETTERS[:12], k=2)) + str(rng.randrange(width)) for _ in range(n))


def corpus():
    rng = random.Random(5)
    rows = [(k, prose(rng, rng.randrange(5, 120)), "en", f"s{k % 3}") for k in range(40)]
    rows += [(100 + k, rows[k][1], "en", "s1") for k in range(5)]
    rows += [(200 + k, rows[k][1].replace(" ", "  ", 1) + " tail", "de", None) for k in range(5)]
    rows += [(3, rows[3][1], "en", "s0"), (300, None, None, "s1"), (301, "", "en", "s2"), (302, " \t\n", "en", "s2"), (None, rows[7][1], None, None)]
    rows += [(303, prose(rng, 20000, 9), "en", "s1"), (304, "é" * 50, "fr", "s2"), (3, prose(rng, 30), "en", "s0"), (None, None, "en", "s0")]
    return [(*r, len(r[1] or ""), "clash", "clash") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def key(rows):
    return sorted(rows, key=repr)


# --- words ---------------------------------------------------------------------


def test_word_hashes_agree_with_split_words():
    texts = [t or "" for _, t, *_ in corpus()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    row, start, end = word_spans(data, offsets)
    want = [(k, w) for k, t in enumerate(texts) for w in words(t)]
    assert [(int(r), data[a:b].tobytes().decode()) for r, a, b in zip(row, start, end)] == want
    hashes = word_hashes(data, start, end)
    assert len({int(h) for h in hashes}) == len({w for _, w in want})
    by_word = {}
    for h, (_, w) in zip(hashes.tolist(), want):
        assert by_word.setdefault(w, h) == h
    assert len(window_hashes(hashes, 3)) == len(hashes) - 2


# --- fingerprints --------------------------------------------------------------


def test_digest_round_trip_and_bounds():
    rng = random.Random(1)
    a, b = (fp.digest(np.frombuffer(prose(rng, 300).encode(), np.uint8)) for _ in range(2))
    assert (fp.digest_codes(fp.digest_text(a)) == a).all()
    assert fp.likeness(a, a) == 1.0 and 0 <= fp.likeness(a, b) < 0.6
    assert fp.likeness(fp.digest(np.zeros(0, np.uint8)), a) >= 0


def test_edited_pairs_match_a_plain_walk(spark, docs, none):
    got = fp.edited_pairs(docs).collect()
    rows = [(i, t or "") for i, t, *_ in corpus()]
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is None, -(i or 0)))
    stands = {i: min((t for j, t in rows if j == i), key=lambda t: t.encode()) for i in ids}
    follows = dict(zip(ids, ids[1:] + ids[:1]))
    want = []
    for i, t in rows:
        n = len(t) // 3
        want.append((i, len(t), hashlib.sha256((t[: len(t) - n] + stands[follows[i]][:n]).encode()).hexdigest()))
    assert key((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == key(want)
    prints = {}
    for (i, t), r in zip(sorted(rows, key=repr), sorted(got, key=lambda r: repr((r.doc_id, "")))):
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert fp.edited_pairs(none).count() == 0
    same = docs.withColumn("f", fp.fingerprint(F.col("text"))).select("text", "f").distinct().collect()
    for r in same:
        prints.setdefault(r.text or "", set()).add(r.f)
    assert all(len(p) == 1 for p in prints.values())


# --- quality -------------------------------------------------------------------


def test_classifier_learns_style_from_positives_and_unlabelled(spark):
    rng = random.Random(2)
    good = [prose(rng, 60) for _ in range(150)]
    bad = [" | ".join(w.upper() + "!!" for w in words(prose(rng, 60))) for _ in range(50)]
    rows = [(k, t) for k, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows + [(900, None), (901, "")], "doc_id long, text string")
    positives = spark.createDataFrame([(k,) for k in range(0, 150, 2)], "doc_id long")
    model = quality.train(docs, positives, F.lit(True))
    assert 0.5 < model.prior < 0.95
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(got) == 202 and all(0 <= s <= 1 for s in got.values())
    assert sum(got[k] >= 0.7 for k in range(150)) > 140 and sum(got[k] < 0.7 for k in range(150, 200)) > 45
    assert quality.train(docs, positives.limit(0), F.lit(True)).score(np.zeros((1, 90)))[0] == 0.5
    assert quality.score(docs.limit(0), model).count() == 0


def test_fit_sample_is_bounded_whatever_the_ids(spark, monkeypatch):
    # 1,000 rows without an id, 1,000 of one labelled id, 1,000 copies of one row, 1,000 others
    rows = [(None, f"null {k}") for k in range(1000)] + [(5, f"hot {k}") for k in range(1000)] + [(7, "copy")] * 1000 + [(10 + k, f"t {k}") for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    positives = spark.createDataFrame([(5,), (7,), (None,)], "doc_id long")
    monkeypatch.setattr(quality, "fit", lambda positive, unlabelled: (len(positive), len(unlabelled)))
    for trained in (100, 500):
        found = quality.train(docs, positives, F.lit(True), trained)
        assert all(0.6 * trained < n < 1.4 * trained for n in found), found
    assert quality.train(docs, positives, F.lit(True)) == (1001, 3001)
    few = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("hash"), "text")
    assert 0 < quality.chosen(few, 10**14, 10**13).count() < 1000  # no rounding to an empty share on large tables
    assert quality.chosen(few.withColumn("hash", F.lit(7).cast("long")), 10**14, 20_000).count() > 0


# --- URL rules -----------------------------------------------------------------


def test_url_rules(spark):
    urls = ["http://A.Net/x", "http://net", "ftp://www.example.net/en/a?b", "http://example.net/english", "x", None, "http://b.com/deep?/q", "http://b.com?x", "http://b.com/deep?/q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("example.net", "/en/", "allow"), ("b.com", "/de", "block"), ("b.com", "/de", "allow"), (None, "/", "block")],
        "host string, path string, verdict string",
    )
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(pages, rules).collect()}
    assert got == {
        0: ("a.net", "/x", "net/", "block"),
        1: ("net", "", None, "allow"),
        2: ("www.example.net", "/en/a", "example.net/en/", "allow"),
        3: ("example.net", "/english", "net/", "block"),
        4: ("", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("b.com", "/deep", "b.com/de", "block"),
        7: ("b.com", "", None, "allow"),
        8: ("b.com", "/deep", "b.com/de", "block"),
    }
    assert {r.verdict for r in url_verdicts(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_verdicts(pages.limit(0), rules).count() == 0


# --- mixing --------------------------------------------------------------------


def test_mix_reaches_targets_and_caps_repeats(spark, docs, none):
    got = mix(docs).collect()
    assert len(got) == len(corpus())
    assert key((r.doc_id, r.size, r.source) for r in got) == key((i, len(words(t)), s) for i, t, _, s, *_ in corpus())
    assert all(r.taken <= 3 * r.size for r in got)
    total = sum(r.size for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, [r.target, r.source_size, 0])[2] += r.taken
    assert sum(t for t, _, _ in by.values()) == pytest.approx(total)
    for target, size, taken in by.values():
        assert target <= 3 * size and abs(taken - target) <= 8
    assert key(mix(docs).collect()) == key(got)
    assert mix(none).count() == 0


@pytest.mark.parametrize("blocks", [1 << 14, 8])
def test_mix_takes_the_blocks_of_the_schedule(spark, monkeypatch, blocks):
    """Word by word: every slot takes its block's words in the order of the layout."""
    monkeypatch.setattr(mixing, "BLOCKS", blocks)
    rows = [(k if k % 4 else None, f"s{k % 7}", 5 + k * k % 97, f"{k * 37 % 61:x}") for k in range(60)] + [(None, "s0", 9, "0"), (None, "s0", 9, "0"), (5, "s9", 0, "1")]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, order string")
    sources, slots = mixing.with_blocks(mixing.source_targets(sized, (5, 2, 1), 3))
    sources = {r.sid: r for r in sources.collect()}
    frame = spark.createDataFrame(list(sources.values()))
    dealt = sorted((r.slot, r.sid, r.rank, r.epoch, r.number) for r in mixing.schedule(frame, slots, 3).collect())
    taken = {sid: [0] * r.source_size for sid, r in sources.items()}
    ranks = dict.fromkeys(sources, 0)
    for _, sid, rank, epoch, number in dealt:
        r = sources[sid]
        assert rank == ranks[sid] == epoch * r.blocks + number
        ranks[sid] += 1
        for at in range(number * r.block, min((number + 1) * r.block, r.source_size)):
            taken[sid][at] += 1
    want, place = [], dict.fromkeys(sources, 0)
    sid_of = {r.source: sid for sid, r in sources.items()}
    for doc_id, source, size, order in sorted(rows, key=lambda r: (r[3], r[0] is not None, r[0], r[2])):
        sid = sid_of[source]
        want.append((doc_id, source, size, sum(taken[sid][place[sid] : place[sid] + size])))
        place[sid] += size
    got = mixing.mix_sized(sized, (5, 2, 1), 3).collect()
    assert key((r.doc_id, r.source, r.size, r.taken) for r in got) == key(want)


def test_repeated_and_null_ids_are_spread_over_the_layout(spark):
    rows = [(None, "s", k % 50, f"{k % 4000:04x}"[::-1]) for k in range(12000)] + [(None, "s", 7, "00aa")] * 9000
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, order string")
    sources, _ = mixing.with_blocks(mixing.source_targets(sized, (1,), 3))
    placed = mixing.laid_out(sized, sources, 1 << 20)
    starts = sorted((r.start, r.size) for r in placed.collect())
    assert len(starts) == len(rows) and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]) if n)


@pytest.mark.parametrize("big", [10**7, 10**10, 10**13])
def test_mix_meets_the_targets_of_small_sources(spark, big):
    # 1,000 words in documents of 10, 500 words and 7 words, beside a source of many words
    rows = [(k, "c", big // 100) for k in range(100)] + [(1000 + k, "a", 10) for k in range(100)] + [(2000, "b", 500), (2001, None, 7)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("order", F.md5(F.col("doc_id").cast("string")))
    got = mixing.mix_sized(sized, (5, 2, 1), 3).collect()
    taken = {s: sum(r.taken for r in got if r.source == s) for s in ("a", "b", None)}
    assert all(r.taken <= 3 * r.size for r in got)
    assert {r.source: r.target for r in got if r.source != "c"} == {"a": 3000, "b": 1500, None: 21}
    assert abs(taken["a"] - 3000) <= 10 and abs(taken["b"] - 1500) <= 10 and abs(taken[None] - 21) <= 10


# --- secrets -------------------------------------------------------------------


def test_secret_spans_match_a_plain_search(spark, none):
    texts = [
        'Password = "abcdef" and token: xyz',
        "secret=token: abcdefgh é api_key='A1b2C3d4' API-KEY=zzzzzzzz",
        "AKIA" + "A1" * 8 + " AKIAshort " + "0123456789abcdef" * 2,
        "passwd:secret=abcdefgh ghp_" + "a" * 40,
        "-----BEGIN RSA PRIVATE KEY-----",
        None,
        "",
        "x" * 300_000 + " token=" + "9" * 30,
        "token=abcdef " * 500,
    ]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(0, texts[0])], "doc_id long, text string").withColumn("spans", F.lit("clash"))
    got = find_secrets(docs).select("doc_id", span_text(F.col("spans")).alias("s")).collect()

    def plain(t):
        out = []
        for k, r in enumerate(RULES):
            for m in re.finditer(r.pattern, t or ""):
                if len(m.group(r.group)) >= r.least:
                    out.append((m.start(), k, m.end()))
        return ",".join(f"{RULES[k].kind}:{a}:{b}" for a, k, b in sorted(out))

    assert key((r.doc_id, r.s) for r in got) == key([(k, plain(t)) for k, t in enumerate(texts)] + [(0, plain(texts[0]))])
    assert find_secrets(none).count() == 0


def test_trigram_queries():
    assert trigram_query("abc?d") == [frozenset({"abd"}), frozenset({"abc", "bcd"})]
    assert trigram_query("[0-9a-f]{24,}") is None and trigram_query("ab.cd") is None
    assert trigram_query("(foo|ba)r+") is None or all(trigram_query("(foo|ba)r+"))


# --- Jaccard -------------------------------------------------------------------


def plain_components(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids, default=None)))
    return out


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 4, 5)])
def test_jaccard_components_match_all_pairs(spark, docs, none, n, num, den):
    rng = random.Random(8)
    rows = [(i, t) for i, t, *_ in corpus()]
    base = words(prose(rng, 150))
    for k in range(60):  # near copies around the threshold, in chains
        base = list(base)
        base[rng.randrange(len(base))] = f"new{k}"
        rows.append((1000 + k, " ".join(base).upper() if k % 7 == 0 else " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_components(df, n, num, den).collect()
    assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(plain_components(rows, n, num, den))
    assert jaccard_components(none, n, num, den).count() == 0


# --- decontamination -----------------------------------------------------------


def test_leaks_with_edits_are_found_and_verified(spark, none):
    rng = random.Random(4)
    items = [(k, prose(rng, rng.randrange(18, 50))) for k in range(12)] + [(90, None), (91, ""), (0, "tiny item")]
    rows, want = [], set()
    for k, (i, t) in enumerate(items[:12]):
        w = words(t)
        for _ in range(int(0.2 * len(w)) if k % 2 else 0):
            w[rng.randrange(len(w))] = "changed"
        rows.append((k, prose(rng, 50) + "\n" + " ".join(w).title() + ". " + prose(rng, 50)))
        want.add((k, i))
    rows += [(50, prose(rng, 300)), (51, None), (52, ""), (53, "a tiny, item"), (54, words(items[2][1])[0])]
    want.add((53, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("leaks", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dec.find_leaks(docs, bench).select("doc_id", F.explode("leaks.item_id").alias("item"), F.size("leaks").alias("n")).collect()
    assert {(r.doc_id, r.item) for r in got} == want
    assert dec.find_leaks(docs, bench.limit(0)).where("size(leaks) > 0").count() == 0
    assert dec.find_leaks(none, bench).count() == 0


def test_leaks_in_other_scripts_and_punctuation(spark):
    items = [(1, "床前明月光，疑是地上霜。"), (2, "ฉันรักประเทศไทย"), (3, "it's a well-known fact – really"), (4, "das größte Haus")]
    texts = ["昨天我讀到床前明月光疑是地上霜這兩句詩", "และฉันรักประเทศไทยมาก", "x “It’s a\u00a0well-known fact—really” y", "x das größte\u3000Haus… y", "床前明月", "das größte-haus-x kein größteHaus"]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    got = dec.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).select("doc_id", F.explode("leaks").alias("leak"))
    assert {(r.doc_id, r.leak.item_id, r.leak.distance) for r in got.collect()} == {(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (6, 4, 0)}
    data = "aé—b漢字c".encode()
    _, start, end = word_spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]), letters_only=True)
    assert [data[a:b].decode() for a, b in zip(start, end)] == ["aé", "b", "漢", "字", "c"]


def test_infix_distance_and_recall():
    a = np.arange(1, 11).astype(np.uint64)
    text = np.concatenate([np.full(5, 99), [1, 2, 3, 77, 5, 6, 8, 9, 10], np.full(4, 98)]).astype(np.uint64)
    assert dec.infix_distance(a, text) == (2, 14)
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(200):
        item = rng.integers(1, 1 << 60, int(rng.integers(18, 60))).astype(np.uint64)
        other = item.tolist()
        for _ in range(int(0.2 * len(item))):
            p, what = int(rng.integers(len(other))), int(rng.integers(3))
            other[p : p + (what != 1)] = [int(rng.integers(1, 1 << 60))] * (what != 2)
        other = (other + rng.integers(1, 1 << 60, len(item)).tolist())[: len(item)]
        keys = dec.cgk_keys(np.stack([item, np.array(other, np.uint64)]), dec.tables_for())
        met += bool((keys[0] == keys[1]).any())
    assert met >= 195


@pytest.mark.parametrize("size", [5, 9, 12, 24, 60, 100])
def test_leaks_at_the_largest_distance_are_found(size):
    # windows as they are placed: shifted by the edits before the q-gram, inside other text
    rng = random.Random(size)
    word = lambda: "".join(rng.choices(LETTERS, k=9))
    items, texts = [], []
    for k in range(250):
        item = [word() for _ in range(size)]
        other = list(item)
        for _ in range(int(0.2 * size)):
            p, what = rng.randrange(len(other)), rng.randrange(3)
            other[p : p + (what != 1)] = [word()] * (what != 2)
        items.append((k, " ".join(item)))
        texts.append(" ".join([word() for _ in range(30)] + other + [word() for _ in range(30)]).encode())
    offsets = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    row, start, end = word_spans(data, offsets, letters_only=True)
    got = dec.leaks_of(word_hashes(data, start, end, lower=True), row, len(texts), dec.prepared(items, 0.2, dec.tables_for()))
    assert all(set(found) == {k} for k, found in got.items())
    assert len(got) >= 0.99 * len(texts)


def test_items_with_a_common_opening_share_their_places():
    """Memory of placing windows does not grow with the items that share a stretch."""
    import tracemalloc

    rng = random.Random(1)
    opening = "which of the following is the best answer to the question below "
    data = np.frombuffer(((opening + "x y z ") * 1300).encode(), np.uint8)
    row, start, end = word_spans(data, np.array([0, len(data)]), letters_only=True)
    hashes = word_hashes(data, start, end, lower=True)
    placed = {}
    for n in (50, 800):
        items = dec.prepared([(k, opening + prose(rng, 12, 5000)) for k in range(n)], 0.2, 1)
        tracemalloc.start()
        placed[n] = dec.placed_windows(hashes, row, items)
        assert tracemalloc.get_traced_memory()[1] < 50e6
        tracemalloc.stop()
    assert len(placed[50]) == 1300 and (placed[50] == placed[800]).all()


def test_leaks_equal_a_search_of_all_windows(spark, monkeypatch):
    """All stretches by exact distance; repeated rows, a very long text, blocks in separate passes."""
    monkeypatch.setattr(dec, "BLOCK_BYTES", 300)
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 16)))) for k in range(20)]
    texts = []
    for _ in range(60):
        w = rng.choices(vocabulary, k=rng.randrange(0, 40))
        for i, t in rng.sample(items, rng.randrange(3)):
            t = words(t)
            if rng.random() < 0.6:
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            at = rng.randrange(len(w) + 1)
            w[at:at] = t
        texts.append(" ".join(w))
    texts += [texts[0], texts[1], " ".join(rng.choices(vocabulary[:20], k=30000)) + " " + items[3][1], None]
    ids = [*range(60), 0, None, 100, 101]
    number = {w: k for k, w in enumerate(vocabulary)}
    want = set()
    for d, t in zip(range(len(ids)), texts):
        text = np.array([number[w] for w in words(t)], np.uint64)
        for i, item in items:
            item = np.array([number[w] for w in words(item)], np.uint64)
            if len(text) and dec.infix_distance(item, text)[0] <= int(0.2 * len(item)):
                want.add((d, i))
    docs = spark.createDataFrame([(d, i, t) for d, (i, t) in enumerate(zip(ids, texts))], "row int, doc_id long, text string")
    found = dec.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.row, r.item) for r in found.select("row", F.explode("leaks.item_id").alias("item")).collect()}
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 40
    assert found.count() == len(ids)


# --- passages ------------------------------------------------------------------


@pytest.mark.parametrize("window", [13, 20, 40])
def test_removed_words_match_a_plain_search(spark, docs, none, window):
    rng = random.Random(6)
    rows = [(i, t) for i, t, *_ in corpus()]
    shared = prose(rng, 70)
    rows += [(500 + k, prose(rng, 20) + " " + shared + "\n" + prose(rng, 20)) for k in range(8)]
    first = {}
    rank = lambda i: float("inf") if i is None else i
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            first[x] = min(first.get(x, float("inf")), rank(i))
    want = []
    for i, t in rows:
        w = words(t)
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < rank(i) for j in range(window)}
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window).collect()
    assert key((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == key(want)
    assert remove_repeats(none, window).count() == 0


# --- language ------------------------------------------------------------------


def test_language_spans_of_mixed_text(spark):
    rng = random.Random(9)
    make = {"aa": lambda: prose(rng, 40).translate({c: None for c in range(48, 58)}), "ru": lambda: " ".join("".join(rng.choices("абвгде", k=5)) for _ in range(40)), "zz": lambda: " ".join("".join(rng.choices("qvxyz", k=5)) for _ in range(40))}
    train = spark.createDataFrame([(f(), lang) for lang, f in make.items() for _ in range(20)] + [("abc", None), (None, "aa")], "text string, lang string")
    model = langid.train(train)
    rows = [(0, make["aa"]()), (1, make["ru"]()), (2, make["aa"]() + " " + make["zz"]() + " " + make["zz"]()), (3, None), (4, "12 !! 3"), (5, "")]
    got = {r.doc_id: r for r in langid.label_languages(spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")), model).collect()}
    assert [got[k].lang_pred for k in range(6)] == ["aa", "ru", "zz", "und", "und", "und"]
    assert [s.lang for s in got[2].spans] == ["aa", "zz"] and abs(got[2].spans[1].first - 40) <= 1
    assert all(0 <= r.score <= 1 for r in got.values())
    empty = langid.train(train.limit(0))
    assert langid.label_languages(train.select("text"), empty).where("lang_pred != 'und'").count() == 0


def test_viterbi_shortcut_equals_the_full_walk():
    rng = np.random.default_rng(7)
    for _ in range(300):
        scores = np.round(rng.normal(size=(int(rng.integers(1, 12)), 3)) * 3)
        best = -np.inf
        for p in np.ndindex(*(3,) * min(len(scores), 7)):
            best = max(best, sum(scores[t, k] for t, k in enumerate(p)) - 4.0 * sum(a != b for a, b in zip(p, p[1:])))
        path = langid.best_path(scores[:7], 4.0)
        assert sum(scores[t, k] for t, k in enumerate(path)) - 4.0 * int((np.diff(path) != 0).sum()) == pytest.approx(best)


# --- lines ---------------------------------------------------------------------


def test_lines_of_later_windows_go(spark, none):
    rows = [(2, "a\nb\nc\nd"), (5, "x\na\nb\nc\ny"), (7, "a\nb"), (8, "b\nc\nd\nb\nc\nd\nq"), (2, "a\nb\nc\nd"), (None, "a\nb\nc"), (9, None), (9, ""), (1, "n\nn\nn\nn")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    got = key((r.doc_id, r.text, r.n_removed) for r in dedup_lines(df).collect())
    assert got == key([(2, "a\nb\nc\nd", 0), (5, "x\ny", 3), (7, "a\nb", 0), (8, "q", 6), (2, "a\nb\nc\nd", 0), (None, "", 3), (9, None, 0), (9, "", 0), (1, "n", 3)])
    assert dedup_lines(none).count() == 0
