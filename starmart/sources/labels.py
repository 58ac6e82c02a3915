"""Code lists: ``value <name>`` blocks of ``CODE = 'LABEL'`` lines ended by ``;``.

The extraction is one Spark job over any number of label files, which are read
line by line and split like any text, also inside a file. A line's block is carried
across splits by a segmented prefix scan: every split counts its lines and its
``;`` lines, a running sum over the splits of a file gives what came before, and
so each line knows its number and how many ``;`` lines precede it. Lines between two
of those form a segment; the first header in a segment opens a block that lasts to the
segment's end. Only (file, segment) headers are joined back, so no block, and no file,
has to fit in one task.

Per block the rules are: tabs dropped; only the first block of a name in a
file counts, and only if a ``;`` ends it; the line that names the block is skipped;
apostrophes dropped (so a doubled one vanishes too); a line is kept
only when it splits on ``=`` into exactly two parts; both parts are stripped
of surrounding whitespace. When a code repeats in a block the last line wins.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.functions.casts import strip

# A block starts at a line ``value <name>`` (SAS character formats put a ``$``
# before the name) and runs up to the first ``;``.
_HEADER = r"^[ ]*value[ ]+\$?(\w+)"


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, split (its first byte), at (order within the split), line, ends (0 or 1), name (of a header)."""
    raw = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.regexp_replace("value", "\t", "").alias("line"),
    )
    name = F.regexp_extract("line", _HEADER, 1)
    return raw.select("*", F.contains("line", F.lit(";")).cast("long").alias("ends"), F.when(name != "", name).alias("name"))


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, pos (line number in the file), segment (``;`` lines before the line), last
    (segments of the file that a ``;`` ends), line, name."""
    lines = _lines(spark, paths)
    # one row per split
    splits = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("ends").alias("ended"))
    file, before = Window.partitionBy("file"), Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    splits = splits.select(
        "file",
        "split",
        F.coalesce(F.sum("n").over(before), zero).alias("lines_before"),
        F.coalesce(F.sum("ended").over(before), zero).alias("ended_before"),
        F.sum("ended").over(file).alias("last"),
    )
    inside = Window.partitionBy("file", "split").orderBy("at")
    earlier = F.sum("ends").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.select("*", F.row_number().over(inside).alias("no"), F.coalesce(earlier, zero).alias("earlier"))
    return lines.join(splits, ["file", "split"]).select(
        "file", (F.col("lines_before") + F.col("no")).alias("pos"), (F.col("ended_before") + F.col("earlier")).alias("segment"), "last", "line", "name"
    )


def label_entries(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every well-shaped line of every block, with its position.

    Columns: file (string), block (string), block_pos (segment of the block in its
    file), line_pos (line number in the file), code (string), label (string).
    """
    lines = numbered_lines(spark, [paths] if isinstance(paths, str) else list(paths))
    headers = lines.where("name is not null and segment < last").groupBy("file", "segment").agg(F.min(F.struct("pos", "name")).alias("head"))
    # Within one file only the first block of a name counts (a later block of
    # the same name is never reached by a reader that stops at the first).
    blocks = headers.groupBy("file", F.col("head.name").alias("block")).agg(F.min(F.struct("segment", "head.pos")).alias("at"))
    blocks = blocks.select("file", "block", "at.segment", F.col("at.pos").alias("head"))
    body = lines.drop("name", "last").join(blocks, ["file", "segment"]).where("pos > head")
    parts = F.split(F.regexp_replace(F.substring_index("line", ";", 1), "'", ""), "=")
    return body.withColumn("parts", parts).where(F.size("parts") == 2).select(
        "file",
        "block",
        F.col("segment").alias("block_pos"),
        F.col("pos").alias("line_pos"),
        strip(F.col("parts")[0]).alias("code"),
        strip(F.col("parts")[1]).alias("label"),
    )


def last_wins(entries: DataFrame) -> DataFrame:
    """One row per (block, code): the label of the last line naming the code.

    Order is file path, block position, line position. ``max_by`` is a
    partial/final aggregate, so a code repeated many times is combined before
    the shuffle.
    """
    order = F.struct("file", "block_pos", "line_pos")
    return entries.groupBy("block", "code").agg(F.max_by("label", order).alias("label"))


def label_blocks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Resolved code lists of all blocks: (block, code, label)."""
    return last_wins(label_entries(spark, paths))


def has_block(spark: SparkSession, paths: str | list[str], block: str) -> bool:
    """Whether any file holds a block of this name.

    ``take(1)`` scans splits a few at a time and stops at the first
    match, so a block found early leaves the other splits unread.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    pattern = r"^[ \t]*value[ \t]+\$?" + re.escape(block.lstrip("$")) + r"\b"
    found = spark.read.text(paths).where(F.col("value").rlike(pattern))
    return len(found.select(F.lit(1)).take(1)) > 0


def code_list(spark: SparkSession, paths: str | list[str], block: str) -> DataFrame:
    """One named block as (code, label); raises when no file holds the block."""
    if not has_block(spark, paths, block):
        raise ValueError(f"code list {block!r} not found in {paths!r}")
    return label_blocks(spark, paths).where(F.col("block") == block.lstrip("$")).drop("block")
