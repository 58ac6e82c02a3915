"""Secret scans by a trigram inverted index (DataFrame only).

Each rule's regular expression yields a Boolean trigram query. The index holds
postings (trigram, text) for every trigram some query asks for, over all
documents. Postings are intersected per alternative; only candidate texts are
verified with the rule's expression. Rules without mandatory trigrams scan all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small, unused
from .trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """``pattern`` must match at least one character. A match counts if ``group``
    (0: all of it) has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, in the order used to break ties. The run
# lengths of access and hex stand in the pattern, where shorter runs cannot match.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further kinds of this library: private key headers, repository tokens, signed web tokens.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("git", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES
SPAN = "array<struct<s:bigint,k:int,e:bigint>>"
#: Matches whose positions are added up at once.
RUN = 256


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(body, kinds): hash of each text that fulfils a rule's trigram query, with those rules.

    Postings carry the text's hash, so copies of a text share theirs and a text
    held by a third of all rows leaves each task as one posting per trigram. The
    table of alternatives has a few rows per rule.
    """
    spark = docs.sparkSession
    queries = [(r.kind, trigram_query(r.pattern)) for r in rules]
    wanted = [(f"{kind}/{i}", kind, t, len(alt)) for kind, q in queries if q is not None for i, alt in enumerate(q) for t in sorted(alt)]
    if not wanted:
        return spark.createDataFrame([], "body long, kinds array<string>")
    vocabulary = sorted({w[2] for w in wanted})
    low = docs.select(F.xxhash64(F.col("text")).alias("body"), F.lower("text").alias("low")).where(F.col("low") != "")
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary]))
    postings = low.select("body", present.alias("present")).select("body", F.explode("present").alias("trigram")).distinct()
    terms = spark.createDataFrame(wanted, "alternative string, kind string, trigram string, needed int")
    return (
        postings.join(F.broadcast(terms), "trigram")
        .groupBy("body", "alternative", "kind")
        .agg(F.count(F.lit(1)).alias("found"), F.first("needed").alias("needed"))
        .where("found = needed")
        .groupBy("body")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end) of a rule's leftmost non-overlapping matches
    that count; code points, end exclusive. The gaps between the matches and the
    matches' own lengths add up to the positions. They are added up in runs of
    ``RUN`` matches and over the runs, so time grows with the number of matches."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    told = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.transform(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), found.alias("all"), told.alias("told")),
        lambda x: F.struct(
            F.length(x["gap"]).cast("long").alias("gap"),
            F.coalesce(F.length(x["all"]), F.lit(0)).cast("long").alias("len"),
            (F.coalesce(F.length(x["told"]), F.lit(0)) >= rule.least).alias("ok"),
        ),
    )
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        span = F.struct(begin.alias("s"), F.lit(order).alias("k"), (begin + x["len"]).alias("e"))
        return F.struct((begin + x["len"]).alias("at"), F.when(x["ok"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def placed(runs):
        before = F.aggregate(runs, F.array(zero), lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) + r["at"])))
        shift = lambda r, at: F.transform(r["out"], lambda x: F.struct((x["s"] + at).alias("s"), x["k"].alias("k"), (x["e"] + at).alias("e")))
        return _bound(before, lambda b: F.flatten(F.transform(runs, lambda r, i: shift(r, F.get(b, i)))))

    def runs_of(all_steps):
        firsts = F.sequence(F.lit(1), F.size(all_steps), F.lit(RUN))
        return _bound(F.transform(firsts, lambda a: F.aggregate(F.slice(all_steps, a, F.lit(RUN)), start, step)), placed)

    return F.when(F.size(found) > 0, _bound(steps, runs_of)).otherwise(F.array().cast(SPAN))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` plus ``spans``: array of (s, k, e), by start, then rule order.

    Null and empty texts have no spans. Equal texts get equal spans; repeated
    rows stay. An empty table gives an empty result. Other columns are carried
    along, whatever their names; a column named spans is replaced. Very long texts and very
    many matches take time in proportion.
    """
    found = saved(candidates(docs, rules), "secret-candidates")
    queried = {r.kind for r in rules if trigram_query(r.pattern) is not None}
    kept = docs.drop("spans")
    body, of, kinds = unused(kept, "body", "of", "kinds")
    marked = kept.withColumn(body, F.xxhash64(F.col("text"))).join(small(found.toDF(of, kinds)), F.col(body) == F.col(of), "left")
    parts = []
    for order, rule in enumerate(rules):
        spans = rule_spans(F.col("text"), rule, order)
        asked = F.array_contains(kinds, rule.kind) if rule.kind in queried else F.col("text").rlike(rule.pattern)
        parts.append(F.when(asked, spans).otherwise(F.array().cast(SPAN)))
    return marked.withColumn("spans", F.array_sort(F.concat(*parts))).drop(body, of, kinds)


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
