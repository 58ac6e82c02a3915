"""Run in a subprocess: every task's first attempt dies; results must stay exact."""

from __future__ import annotations

import sys
import tempfile

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starmart.operators.merge import insert_only  # noqa: E402
from starmart.operators.quality import key_profile, write_parquet_observed  # noqa: E402

spark = (
    SparkSession.builder.master("local[2,4]")  # 2 threads, up to 4 attempts per task
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")


def flaky(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0:
        raise RuntimeError("simulated executor loss")
    yield from batches


base = spark.range(0, 20000, numPartitions=4).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
target = base.where("k < 15000")
batch = base.where("k >= 10000").mapInPandas(flaky, "k long, v long")
new = insert_only(target, batch, ["k"]).inserted
out = tempfile.mkdtemp(prefix="retry-") + "/new"
metrics = write_parquet_observed(new, out, partition_by=["v"])
back = key_profile(spark.read.parquet(out), ["k"]).first()
print(f"RESULT written={metrics['rows']} read={back['rows']} dups={back['duplicate_keys']}")
