"""Pipeline stages against plain versions, and joins with hot keys."""

from __future__ import annotations

import random

import corpus_pipeline as cp
from pyspark.sql import functions as F

from starmart.llm import common
from starmart.llm.common import join_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"
GERMAN = "der die das und nicht über straße wird auch nach einer werden können gegen zwischen".split()
ENGLISH = "the and not with there which would their about after other these where through should".split()


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), "x") for r in rows], SCHEMA)


def shingles(text):
    t = (text or "").lower().split()
    return {tuple(t[k : k + 5]) for k in range(len(t) - 4)} if len(t) >= 5 else ({tuple(t)} if t else set())


def plain_survivors(rows):
    """One row of each group of linked rows; rows without words all stay."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(find(k) if sets[k] else ("own", k), []).append(r)
    out = []
    for group in groups.values():
        least = min((r[0] is None, r[0] or 0) for r in group)
        out.append({r[1] for r in group if (r[0] is None, r[0] or 0) == least})
    return out, len(groups)


def test_near_duplicates_leave_one_row_of_each_group(spark):
    rng = random.Random(2)
    rows = [(k, prose(rng, ENGLISH, 60), "en", "a") for k in range(12)]
    rows += [(50 + k, rows[k][1] + " tail", "en", "a") for k in range(4)]
    rows += [rows[0], rows[0], (2, rows[2][1] + " other end", "en", "b")]
    rows += [(None, prose(rng, ENGLISH, 60), None, "a"), (None, prose(rng, ENGLISH, 60), None, "a"), (None, rows[5][1], None, None)]
    rows += [(None, rows[-3][1], None, "a"), (80, None, "en", "a"), (81, "", "en", "a"), (82, " \n", "en", "a"), (83, "one two", "en", "a"), (84, "one two", "en", "a")]
    got = [(r.doc_id, r.text) for r in cp.near_duplicates(spark, frame(spark, rows), "").collect()]
    groups, n = plain_survivors(rows)
    assert len(got) == n
    assert all(any(text in g for g in groups) for _, text in got)
    assert sum(doc is None for doc, _ in got) == 2  # two unrelated texts without doc_id both stay
    assert cp.near_duplicates(spark, frame(spark, rows).where("false"), "").columns == cp.COLUMNS


def test_language_stage_rejects_texts_without_letters_only(spark):
    rng = random.Random(3)
    rows = [(k, prose(rng, ENGLISH if k % 2 else GERMAN, 50), "en" if k % 2 else "de", "a") for k in range(30)]
    rows += [(40, prose(rng, GERMAN, 50), None, "a"), (41, None, "en", "a"), (42, "12 34 %", "en", "a"), (43, "", None, None)]
    got = {r.doc_id: r.lang for r in cp.language_id(spark, frame(spark, rows), "").collect()}
    assert got == {**{k: "en" if k % 2 else "de" for k in range(30)}, 40: "de"}


def test_line_stage_keeps_first_occurrences(spark):
    shared = ["alpha", "beta", "gamma", "delta"]
    rows = [(1, "\n".join(["own 1", *shared]), "en", "a"), (2, "\n".join([*shared, "own 2"]), "en", "a"), (3, "\n".join(shared), "en", "a"), (4, "a\nb", "en", "a"), (5, None, None, None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in cp.line_dedup(spark, frame(spark, rows), "").collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: ("own 2", 5), 4: ("a\nb", 3), 5: (None, 0)}


def test_leaky_documents_go_and_clean_ones_stay(spark, tmp_path):
    rng = random.Random(4)
    item = prose(rng, [f"w{k}" for k in range(400)], 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "probe"))
    names = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").schema
    values = [tuple(item if f.dataType.simpleString() == "string" else 1 for f in names)]
    spark.createDataFrame(values, names).write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, prose(rng, ENGLISH, 80) + " " + item + " " + prose(rng, ENGLISH, 30), "en", "a"), (2, prose(rng, ENGLISH, 150), "en", "a"), (3, None, None, None)]
    got = {r.doc_id for r in cp.decontaminate(spark, frame(spark, rows), str(tmp_path)).collect()}
    assert got == {2, 3}


def test_join_groups_equals_a_plain_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 3)
    rows = spark.range(300).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 40).cast("long").alias("k"), "id")
    groups = rows.groupBy("k").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("k != 7")
    for how in ("inner", "left"):
        want = rows.join(groups.drop("n"), ["k"], how)
        got = join_groups(rows, groups, ["k"], how)
        assert sorted(map(tuple, got.select("k", "id", "first").collect()), key=str) == sorted(map(tuple, want.select("k", "id", "first").collect()), key=str)
