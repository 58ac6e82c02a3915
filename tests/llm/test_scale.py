"""Very long texts, many matches and lines, and input columns named like inner ones."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from starmart.llm.decontaminate import find_leaks
from starmart.llm.line_dedup import dedup_lines
from starmart.llm.secrets import find_secrets
from starmart.llm.url_filter import url_verdicts

RULES = [("net", "/", "block"), ("a.b.net", "/en/", "allow")]
INNER = ["_body", "_covered", "_id", "_text_hash", "_kinds", "_of", "best", "_found", "body", "covered", "of", "own", "lines", "kinds", "found", "n", "key", "number"]


def urls(labels):
    return "http://" + "x." * labels + "net/" + "p/" * labels


CASES = {
    "lines": (lambda n: "\n".join(["same", "three", "lines"] * 2 + [f"line {k}" for k in range(n)]), lambda d: dedup_lines(d).agg(F.sum("n_removed")), 40_000),
    "matches": (lambda n: "token=abcdef1 " * n, lambda d: find_secrets(d).agg(F.sum(F.size("spans"))), 40_000),
    "labels": (urls, lambda d: url_verdicts(d.withColumnRenamed("text", "url"), d.sparkSession.createDataFrame(RULES, "host string, path string, verdict string")).agg(F.count("rule")), 8_000),
}


@pytest.mark.parametrize("case", CASES)
def test_time_grows_with_the_text(spark, case):
    """Twice the text takes about twice the time (a square would take four times)."""
    text, job, n = CASES[case]

    def seconds(size):
        docs = spark.createDataFrame([(1, text(size))], "doc_id long, text string")
        best = None
        for _ in range(2):
            began = time.perf_counter()
            found = job(docs).first()[0]
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        return best, found

    seconds(n // 8)  # compile
    (half, _), (whole, found) = seconds(n // 2), seconds(n)
    assert found > 0
    assert whole < 3 * half + 1.0 and whole < 20, (half, whole)


def test_columns_named_like_inner_ones_are_carried(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "a\nb\nc\npassword: abcdefg"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(f"keep {c}") for c in INNER})
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    for out in (dedup_lines(docs), find_secrets(docs), url_verdicts(docs.withColumn("url", F.lit("http://c.net/")), rules), find_leaks(docs, bench)):
        kept = out.select("doc_id", *INNER).collect()
        assert len(kept) == 3 and all(r[c] == f"keep {c}" for r in kept for c in INNER)
    assert [r.n_removed for r in dedup_lines(docs).orderBy("doc_id").collect()] == [0, 3, 0]
    assert [r.text for r in dedup_lines(docs).orderBy("doc_id").collect()] == ["a\nb\nc\nd", "password: abcdefg", None]
