"""Session helpers: shared scratch space and a local session for tests/bench.

Library code never creates or configures a session; it receives one. The only
configuration it touches is the checkpoint directory, and only when the
cluster left it unset (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is a distributed path every executor can reach. When the
    setting is absent (local tests) a private folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no SparkContext
        sc = None
    base = spark.conf.get("spark.checkpoint.dir", None)
    if sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None) or base
        if not base and sc.getCheckpointDir():
            return sc.getCheckpointDir().rstrip("/")
    if not base and sc is not None and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="starmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    return f"{shared_dir(spark)}/starmart/{name}-{uuid.uuid4().hex}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starmart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
