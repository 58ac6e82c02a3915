"""Line dedup by overlapping three-line windows (DataFrame only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_groups, saved, small, unused

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _body(text: Column) -> Column:
    """60 bits of the text's md5; null counts as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")


def repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, body, covered): 0-based line numbers to remove per document.

    The hashes of ``window`` consecutive lines form a window's key. The first
    occurrence of a key, by doc_id (null last), then md5 of the text, then line,
    stays; every later one covers its lines. Documents are told apart by
    doc_id and that hash (``body``). Counts are pre-aggregated, so a window that
    a third of all documents hold leaves each task as one row; the join back
    does not shuffle the rows of such windows.
    """
    hashes = docs.select(
        "doc_id",
        _body(F.col("text")).alias("body"),
        F.transform(_lines(F.coalesce("text", F.lit(""))), lambda line: F.xxhash64(line)).alias("hashes"),
    )
    windows = hashes.where(F.size("hashes") >= window).select(
        "doc_id",
        "body",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(1), F.size("hashes") - (window - 1)),
                lambda i: F.struct(*[F.element_at("hashes", i + k).alias(f"h{k}") for k in range(window)]),
            )
        ).alias("line", "w"),
    )
    keys = [f"h{k}" for k in range(window)]
    windows = saved(windows.select("doc_id", "body", "line", "w.*"), "line-windows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body", "line")
    first = (
        windows.groupBy(*keys)
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    later = join_groups(windows, first, keys).where(~place.eqNullSafe(F.col("first")))
    return later.select("doc_id", "body", F.explode(F.array(*[F.col("line") + k for k in range(window)])).alias("line")).groupBy("doc_id", "body").agg(
        F.collect_set("line").alias("covered")
    )


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with its text cut to the kept lines, plus n_lines and n_removed
    (columns of those names are replaced).

    Lines are parted by newlines. Text with no removed line is unchanged; null
    stays null with no lines; texts with fewer than ``window`` lines have no
    window and stay. Rows equal in doc_id and text are one document and are
    judged alike; null doc_ids come last. An empty table gives an empty result.
    Other columns are carried along, whatever their names. A very long text is split
    once and put together once, so its time grows with its lines.
    """
    of, body, covered, own, lines = unused(docs, "of", "body", "covered", "own", "lines")
    found = saved(repeated_lines(docs, window), "line-covered").toDF(of, body, covered)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    # lines take the text's place below the join, so that they are a column above it, not split anew per line
    marked = docs.select(*others, _lines(F.col("text")).alias(lines), _body(F.col("text")).alias(own))
    joined = marked.join(small(found), F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(own) == F.col(body)), "left")
    n = F.coalesce(F.size(lines), F.lit(0))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(covered))
    kept = F.when(F.col(covered).isNull(), F.col(lines)).otherwise(F.transform(kept, lambda i: F.get(F.col(lines), i)))
    new = {
        "text": F.when(F.col(lines).isNotNull(), F.array_join(kept, "\n")).alias("text"),
        "n_lines": F.when(F.col(lines).isNull(), F.lit(0)).otherwise(n).cast("long").alias("n_lines"),
        "n_removed": F.coalesce(F.when(F.col(covered).isNotNull(), F.size(covered)), F.lit(0)).cast("long").alias("n_removed"),
    }
    names = [*docs.columns, *(c for c in new if c not in docs.columns)]
    return joined.select(*(new[c] if c in new else F.col(f"`{c}`") for c in names))
