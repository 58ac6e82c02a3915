"""The two stages of a run.

Stage 1 (``build_star_files``): raw files -> fact and dimension Parquet files
of one run, each write observed (row count, conversion rejects) and read back.

Stage 2 (``load_star_files``): the run's star files are loaded as staging
frames under the table contracts, rows with null keys set apart, merged into the
published tables (fact insert-only, dimensions type-1), written as new unpublished
versions, checked (read-back count and content, null keys, duplicate keys), and only
when every table passes are the versions published, in one commit. Load order: fact, states, origin, unemployment.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.quality import WriteCheck, read_back, write_parquet_observed
from starmart.plans.marts import stage_arrivals
from starmart.plans.publish import StagedWrite, TableStore, stored_columns
from starmart.plans.tables import (
    REJECT_FLAGS,
    build_fact_with_rejects,
    build_origin,
    build_states,
    build_unemployment,
    cluster_by_arrival_month,
    fact_reject_metrics,
    require_raw_columns,
    with_arrival_partition,
)
from starmart.schemas import ARRIVALS, FACT, ORIGIN, REGISTRY, STATES, UNEMPLOYMENT
from starmart.sources.readers import read_parquet
from starmart.sources.staging import read_staging, split_rejects


class CheckFailed(RuntimeError):
    """Raised when a run's checks fail; nothing of the run was published."""


@dataclass
class StarFiles:
    """Paths of one run's stage-1 output."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


@dataclass
class BuildResult:
    files: StarFiles
    checks: dict[str, WriteCheck] = field(default_factory=dict)
    rejects: dict[str, int] = field(default_factory=dict)


def build_star_files(
    spark: SparkSession,
    raw_fact: str | list[str],
    code_lists: str | list[str],
    states_csv: str | list[str],
    rates_csv: str | list[str],
    out_root: str,
    mode: str = "overwrite",
) -> BuildResult:
    """Stage 1: build the four tables from raw files and write them under ``out_root``.

    Like the surveyed job each table directory is replaced (``mode``); stage 1
    output is private to its run, so replacing it never hides published data.
    """
    files = StarFiles(out_root)
    result = BuildResult(files)

    # The files' own schema is read (numbers may be stored as double or int);
    # only the 18 used columns are scanned.
    raw = require_raw_columns(read_parquet(spark, raw_fact))
    fact = cluster_by_arrival_month(with_arrival_partition(build_fact_with_rejects(raw)))
    metrics = write_parquet_observed(
        fact,
        files.path(FACT.name),
        partition_by=FACT.partition_by,
        extra_metrics=fact_reject_metrics(),
        mode=mode,
        drop_after=[REJECT_FLAGS],
    )
    result.rejects = {k: int(v or 0) for k, v in metrics.items() if k.startswith("rejected_")}
    result.checks[FACT.name] = read_back(spark, FACT.name, files.path(FACT.name), int(metrics["rows"]), stored_columns(FACT))

    for spec, df in (
        (ORIGIN, build_origin(spark, code_lists)),
        (STATES, build_states(spark, states_csv)),
        (UNEMPLOYMENT, build_unemployment(spark, rates_csv)),
    ):
        m = write_parquet_observed(df, files.path(spec.name), mode=mode)
        result.checks[spec.name] = read_back(spark, spec.name, files.path(spec.name), int(m["rows"]), stored_columns(spec))
    return result


@dataclass
class LoadResult:
    staged: dict[str, StagedWrite]
    published: bool
    rejected: dict[str, int] = field(default_factory=dict)
    rejects_path: str | None = None

    def report_rows(self) -> list[tuple]:
        """(table_name, version, rows, null_key_rows, duplicate_keys, passed) per table."""
        return [
            (s.spec.name, s.version, s.written_rows, s.null_key_rows + self.rejected.get(s.spec.name, 0), s.duplicate_keys, not s.problems)
            for s in self.staged.values()
        ]


def write_rejects(spark: SparkSession, store: TableStore, rejects: list[DataFrame]) -> tuple[str | None, dict[str, list]]:
    """The rejected rows of all tables, written beside the published ones, with
    (reason, rows, one row) per table for the report. One job over all tables."""
    path = f"{store.root}/_rejects/run={uuid.uuid4().hex}"
    rows = reduce(DataFrame.unionByName, rejects)
    if write_parquet_observed(rows, path)["rows"] == 0:
        return None, {}
    found = spark.read.parquet(path).groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    out: dict[str, list] = {}
    for r in found.collect():  # one row per table and set of null key columns
        out.setdefault(r.table_name, []).append((r.reason, r.n, r.row))
    return path, out


def load_star_files(
    spark: SparkSession,
    store: TableStore,
    files: StarFiles,
    raise_on_failure: bool = True,
    set_rejects_aside: bool = False,
    maintain_mart: bool = False,
) -> LoadResult:
    """Stage 2: merge one run's star files into the published tables.

    Rows with a null key are written to a reject table; they stop the load unless
    ``set_rejects_aside``. Each table's new version is written and checked first, so the
    error names what is wrong in every table; the commit that publishes them is made only
    when every table passed, and only if no other run published meanwhile. With
    ``maintain_mart`` the monthly mart takes the new fact batch in, in the same commit.
    """
    state = store.state()
    split = {name: split_rejects(read_staging(spark, files.path(name), spec), spec) for name, spec in REGISTRY.items()}
    path, rejected = write_rejects(spark, store, [rejects for _, rejects in split.values()])
    staged: dict[str, StagedWrite] = {}
    for name, spec in REGISTRY.items():  # fact, states, origin, unemployment
        stage = store.stage_insert if spec.insert_only else store.stage_upsert
        staged[name] = stage(spec, split[name][0], state)
    if maintain_mart:
        staged[ARRIVALS.name] = stage_arrivals(store, staged[FACT.name])
    failed = {n: list(s.problems) for n, s in staged.items() if s.problems}
    if not set_rejects_aside:
        for name, reasons in rejected.items():
            failed.setdefault(name, []).extend(f"{n} rows with {reason}, such as {row}" for reason, n, row in sorted(reasons))
    result = LoadResult(staged, not failed, {name: sum(n for _, n, _ in r) for name, r in rejected.items()}, path)
    if failed:
        if raise_on_failure:
            raise CheckFailed(f"checks failed, nothing published: {failed}")
        return result
    store.publish(*staged.values())
    return result
