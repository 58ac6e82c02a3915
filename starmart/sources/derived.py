"""Raw-shaped inputs derived from the driver's test tables.

The test tables hold a TPC-H-like star schema, not border arrivals, code-list
files or rate sheets. These functions derive raw-shaped inputs from them with
Spark, so every query's work grows with the tables it reads:

* ``raw_arrivals``: one raw arrival row per order (orders left-joined to
  customer), typed like the raw Parquet file.
* ``write_csv``: any frame as header CSV files, every value quoted text.
* ``write_label_file``: rows as ``value <block>`` code-list text, CRLF lines.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import SAS_EPOCH

# The framing function below runs in Python workers. Ship it by value, so a
# worker needs only numpy and pandas, not this package on its path (a session
# started outside the repository, or a cluster without --py-files).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw arrival rows, one per order, columns and types of the raw fact file."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    odate = F.to_date("o_orderdate")
    day = F.datediff(odate, F.lit(SAS_EPOCH).cast("date")).cast("double")
    age = F.col("c_custkey") % 90
    return j.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        ((F.col("c_nationkey") + 1) % 25).cast("double").alias("i94res"),
        F.col("o_orderpriority").alias("i94port"),
        day.alias("arrdate"),
        (F.col("o_orderkey") % 4).cast("double").alias("i94mode"),
        F.col("c_mktsegment").alias("i94addr"),
        F.when(F.col("o_orderkey") % 11 != 0, day + 14).alias("depdate"),
        age.cast("double").alias("i94bir"),
        (F.col("o_orderkey") % 3 + 1).cast("double").alias("i94visa"),
        F.date_format(odate, "yyyyMMdd").alias("dtadfile"),
        F.col("o_orderstatus").alias("visapost"),
        (F.year(odate) - age).cast("double").alias("biryear"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("D/S"))
        .otherwise(F.date_format(F.date_add(odate, 180), "MMddyyyy"))
        .alias("dtaddto"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit("M"))
        .when(F.col("o_custkey") % 3 == 1, F.lit("F"))
        .alias("gender"),
        F.col("c_name").alias("airline"),
        F.col("o_custkey").cast("string").alias("fltno"),
        (F.col("o_orderkey") + 5000000000).cast("double").alias("admnum"),
    )


def rate_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unemployment-shaped rows from orders: Year, Month name, State, County, Rate as text."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.year("o_orderdate").cast("string").alias("Year"),
        F.date_format("o_orderdate", "MMMM").alias("Month"),
        F.col("o_orderpriority").alias("State"),
        F.col("o_custkey").cast("string").alias("County"),
        F.col("o_totalprice").cast("string").alias("Rate"),
    )


#: Entries of one derived code-list file, about.
ENTRIES_PER_FILE = 5_000


def write_csv(df: DataFrame, path: str) -> str:
    """Write ``df`` as header CSV, every value quoted; one header per file."""
    df.write.mode("errorifexists").option("header", True).option("quoteAll", True).csv(path)
    return path


def _frame_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Put a ``value <block>`` header before each run of a block and ``;`` after it.

    Rows arrive sorted by block within the partition; the header is folded into
    the first line of a run so the output keeps one row per input row.
    """
    current = first = None
    for pdf in batches:
        if pdf.empty:
            continue
        blocks = pdf["block"].to_numpy(dtype=object)
        prev = np.concatenate([np.array([current], dtype=object), blocks[:-1]])
        starts = blocks != prev
        header = "value " + pdf["block"] + "\r\n\t/* " + pdf["block"] + " = code = label */\r\n"
        closing = pd.Series(np.where(prev == None, "", ";\r\n\r\n"), index=pdf.index)  # noqa: E711
        prefix = (closing + header).where(starts, "")
        current, first = blocks[-1], blocks[0] if first is None else first
        yield pd.DataFrame({"value": prefix + pdf["line"]})
    if current is not None:
        yield pd.DataFrame({"value": [f";\r\n\r\nvalue {first}\r\n\t1\t=\t'a second block is not read' ;"]})


def write_label_file(
    df: DataFrame,
    block: Column,
    code: Column,
    label: Column,
    order: Sequence[Column],
    path: str,
    files: int | None = None,
) -> str:
    """Write rows as code-list text: ``\\t<code>\\t=\\t'<label>'`` lines in blocks.

    Rows are range-partitioned on (block, order...), so file ``part-N`` holds
    an ordered slice and the files in name order give the global order a
    last-wins reader relies on. Each file repeats the header of the blocks it
    holds, so no block has to fit in one task. The number of files follows the
    number of rows (``ENTRIES_PER_FILE``), so no file grows with the data. Every file
    ends with a second block of its first name, which readers leave out.
    """
    names = [f"_o{i}" for i in range(len(order))]
    # some labels end in a doubled apostrophe, which vanishes, and some lines are followed by one with two marks
    text, some = code.cast("string"), F.pmod(F.xxhash64(code.cast("string")), F.lit(5))
    quoted = F.concat(F.lit("\t=\t'"), label.cast("string"), F.when(some == 0, F.lit("''")).otherwise(""), F.lit("'"))
    second = F.when(some == 1, F.concat(F.lit("\r\n\t"), text, F.lit(" = 'not' = 'read'"))).otherwise("")
    lines = df.select(
        block.cast("string").alias("block"),
        F.concat(F.lit("\t"), text, quoted, second).alias("line"),
        *[o.alias(n) for o, n in zip(order, names)],
    )
    files = files or max(1, -(-df.count() // ENTRIES_PER_FILE))
    ranged = lines.repartitionByRange(files, "block", *names)
    framed = ranged.sortWithinPartitions("block", *names).select("block", "line").mapInPandas(
        _frame_blocks, "value string"
    )
    framed.write.mode("errorifexists").option("lineSep", "\r\n").text(path)
    return path
