"""URL rules by hashed host-suffix and path-prefix expressions (DataFrame only).

Every URL is expanded into expressions ``host suffix + path prefix``. The short
prefix (8 hex digits) of an expression's SHA-256 is equi-joined with the rules'
prefixes; the full digest confirms a hit, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_groups, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PREFIX_HEX = 8


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty as above."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """One row per (host, path) with digest; of two verdicts ``block`` stays.
    Rows with a null host, path or verdict are no rules."""
    return (
        rules.dropna(subset=["host", "path", "verdict"])
        .groupBy(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
        .withColumn("rule_digest", F.sha2("rule", 256))
        .withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX))
    )


def url_verdicts(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` plus host, path, rule, verdict (columns of those names are replaced).

    ``rules``: host, path, verdict (allow or block). A rule fits its host and all
    subdomains when the URL's path starts with the rule's. The longest rule
    (code points of host and path) wins, of equal ones that with the longer
    host. Without a fitting rule the verdict is ``default`` and rule is null.

    Null or malformed URLs have empty host and path. Repeated rows stay, each
    with its verdict; an empty table gives an empty result. Distinct (host,
    path) are judged once; a (host, path) that very many pages share is joined without
    a shuffle. Host suffixes and path prefixes are cut at the lengths that rules have (in labels
    and characters), so any rule works, and a very long URL costs as many expressions as
    any other; those lengths are all that reaches the driver. Other columns are carried
    along, whatever their names.
    """
    prepared = prepared_rules(rules)
    labels = F.size(F.split("rule_host", r"\."))
    cuts = prepared.agg(F.collect_set(F.length("rule_path")), F.collect_set(labels)).first()
    judged = pages.drop("host", "path", "rule", "verdict").withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    sites = judged.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    suffixes = F.array(*(F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n)) for n in sorted(cuts[1])), F.lit(None).cast("string"))
    prefixes = F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(cuts[0])), F.lit(None).cast("string"))
    expressions = (
        sites.select("host", "path", F.explode(F.array_compact(suffixes)).alias("suffix"))
        .select("host", "path", "suffix", F.explode(F.array_compact(prefixes)).alias("start"))
        .select("host", "path", F.sha2(F.concat("suffix", "start"), 256).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    )
    best = (
        expressions.join(small(prepared), "prefix")
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct("rule", "rule_verdict"),
                F.struct(F.length("rule"), F.length("rule_host"), "rule_verdict"),
            ).alias("best")
        )
    )
    found = sites.join(best, ["host", "path"], "left").select("host", "path", "n", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("verdict"))
    out = join_groups(judged, found, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    return out.select(*(F.col(f"`{c}`") for c in judged.columns), "rule", "verdict")
