"""Run in a subprocess from an unrelated folder: the package is on the driver's
path only, yet queries with Python worker code must still run."""

from __future__ import annotations

import sys

sys.path.insert(0, sys.argv[1])

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as E  # noqa: E402

spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
q = E.queries()
counts = {name: q[name](spark, sys.argv[2]).count() for name in ("label_blocks", "origin_build")}
print("RESULT " + " ".join(f"{k}={v}" for k, v in sorted(counts.items())))
