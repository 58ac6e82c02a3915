"""Published tables: new directories only, checks before publishing, one commit file.

No lakehouse format is assumed. A table is a list of directories (units), named by
the latest commit (``plans/commits.py``):

* the insert-only fact is stored as batches, ``<table>/batch=<n>/attempt=<id>/``,
  partitioned inside by arrival year and month; a unit is one month of a batch.
  Beside each batch lies a filter of its keys, so that a later load reads only the
  batches that may hold one of its keys;
* a dimension is stored by key bucket, ``<table>/version=<n>/attempt=<id>/bucket=<b>``.
  An upsert writes only buckets in which a row changes; the others are carried
  over by reference.

``compact`` packs small month directories of several batches into new ones, and
``retire`` removes directories that no kept commit names.

Every write is a normal Spark job with an output committer, so lost executors
only cause task retries. The commit file is the single step that makes a run
visible, for all its tables at once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from starmart.operators.joins import fits
from starmart.operators.keyfilter import filter_words, key_filter, may_hold
from starmart.operators.merge import insert_only, upsert
from starmart.operators.quality import (
    content_checksum,
    duplicate_offenders,
    key_profile,
    null_key_sample,
    write_parquet_observed,
)
from starmart.plans.commits import CommitLog, KeyFilter, State, Unit
from starmart.plans.tables import cluster_by_arrival_month, with_arrival_partition
from starmart.schemas import TableSpec

#: Rows of a dimension's key bucket, about; the number of buckets follows from the first load.
BUCKET_ROWS = 500_000
BUCKET = "bucket"
#: Month directories whose files are smaller than half of this on average are packed together.
FILE_BYTES = 256 << 20


def stored_columns(spec: TableSpec) -> StructType:
    """Declared columns plus the storage partition columns (an empty batch
    has no footer to infer from)."""
    return StructType(spec.schema.fields + [StructField(p, IntegerType()) for p in spec.partition_by])


@dataclass
class StagedWrite:
    """A written but unpublished version with what the checks found."""

    spec: TableSpec
    version: int
    path: str
    attempt: str
    written_rows: int
    read_rows: int
    null_key_rows: int
    duplicate_keys: int
    content_equal: bool
    base: State
    units: list[Unit]
    dropped: set[str] = field(default_factory=set)  # bucket parts that the new units replace
    filters: list[KeyFilter] = field(default_factory=list)
    buckets: int | None = None
    samples: list[str] = field(default_factory=list)

    @property
    def problems(self) -> list[str]:
        out = []
        if self.written_rows != self.read_rows:
            out.append(f"read back {self.read_rows} rows, wrote {self.written_rows}")
        elif not self.content_equal:
            out.append("rows read back differ from the rows written")
        if self.null_key_rows:
            out.append(f"{self.null_key_rows} rows with a null key")
        if self.duplicate_keys:
            out.append(f"{self.duplicate_keys} duplicated keys")
        return out + self.samples


class TableStore:
    """Parquet tables under one root (a shared, durable path)."""

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_rows = bucket_rows
        self.log = CommitLog(spark, f"{self.root}/_commits")

    # -- layout ---------------------------------------------------------------

    def table_dir(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.name}"

    def attempt_dir(self, spec: TableSpec, version: int, attempt: str) -> str:
        """One directory per staging attempt: what was checked is never overwritten."""
        return f"{self.table_dir(spec)}/{'batch' if spec.insert_only else 'version'}={version}/attempt={attempt}"

    def unit_dir(self, spec: TableSpec, unit: Unit) -> str:
        return f"{self.attempt_dir(spec, unit.version, unit.attempt)}/{unit.part}"

    def filter_dir(self, f: KeyFilter) -> str:
        return f"{self.root}/_keys/{f.table}/words={f.words}/batch={f.version}/attempt={f.attempt}"

    # -- reading --------------------------------------------------------------

    def state(self) -> State:
        """The latest published state (one listing and one small file)."""
        return self.log.latest()

    def all_published_versions(self) -> dict[str, list[int]]:
        """Published version numbers per table."""
        return self.state().versions

    def published_versions(self, spec: TableSpec) -> list[int]:
        return self.state().versions.get(spec.name, [])

    def next_version(self, spec: TableSpec) -> int:
        return self.state().next_version(spec.name)

    def read_units(self, spec: TableSpec, units: list[Unit], extra: tuple[str, ...] = ()) -> DataFrame:
        """Rows of some units, with the storage columns ``extra``."""
        cols = [*spec.schema.fieldNames(), *extra]
        if not units:
            empty = self.spark.createDataFrame([], spec.schema)
            return empty.withColumns({p: F.lit(None).cast("int") for p in extra}).select(*cols)
        return self._files(spec, units).select(*cols)

    def _files(self, spec: TableSpec, units: list[Unit]) -> DataFrame:
        paths = [self.unit_dir(spec, u) for u in units]
        return self.spark.read.schema(stored_columns(spec)).option("basePath", self.table_dir(spec)).parquet(*paths)

    def current(self, spec: TableSpec, with_partitions: bool = False, state: State | None = None) -> DataFrame:
        """The published content (an empty frame of the declared schema if none).

        For the fact, ``with_partitions`` keeps arrival_year/arrival_month so
        filters on them prune whole directories.
        """
        units = (state or self.state()).of(spec.name)
        return self.read_units(spec, units, tuple(spec.partition_by) if with_partitions else ())

    def batches_holding(self, spec: TableSpec, batch_keys: DataFrame, state: State) -> list[tuple[int, str]] | None:
        """(batch, attempt) of the batches that may hold one of ``batch_keys``.

        None if the keys are too many to be sent to every filter: with that many,
        each batch would be hit anyway. One filter row covers some 2.7 keys.
        """
        filters = [f for f in state.filters if f.table == spec.name]
        keys = batch_keys.select(*spec.keys).dropna().distinct()
        if not filters or not fits(keys):
            return [] if not filters else None
        found = None
        for words in sorted({f.words for f in filters}):
            paths = [self.filter_dir(f) for f in filters if f.words == words]
            rows = self.spark.read.schema("word long, bits long, batch long, attempt string").option("basePath", f"{self.root}/_keys/{spec.name}/words={words}").parquet(*paths)
            hit = may_hold(rows, words, keys, spec.keys).select("batch", "attempt")
            found = hit if found is None else found.unionByName(hit)
        # at most one row per batch reaches the driver
        return [(r.batch, r.attempt) for r in found.distinct().collect()]

    def target_for(self, spec: TableSpec, staging: DataFrame, state: State) -> DataFrame:
        """What of the published fact may share a key with ``staging``."""
        units = state.of(spec.name)
        held = self.batches_holding(spec, staging, state)
        if held is not None:
            units = [u for u in units if (u.version, u.attempt) in set(held)]
        return self.read_units(spec, units)

    # -- writing --------------------------------------------------------------

    def stage_insert(self, spec: TableSpec, staging: DataFrame, state: State) -> StagedWrite:
        """Stage the rows of ``staging`` whose key is not published yet, as a new batch."""
        if state.of(spec.name):
            new = insert_only(self.target_for(spec, staging, state), staging, spec.keys).inserted
        else:
            new = staging.select(*spec.schema.fieldNames()).dropDuplicates()
        return self.stage(spec, new, state.next_version(spec.name), state)

    def stage_upsert(self, spec: TableSpec, staging: DataFrame, state: State) -> StagedWrite:
        """Stage a type-1 upsert: only buckets that a changed row falls into are written.

        A row of ``staging`` that stands unchanged in the table changes nothing. The
        table is rewritten as a whole, into more buckets, only when it has grown to
        four times the rows that its buckets were made for.
        """
        units, buckets = state.of(spec.name), state.buckets.get(spec.name)
        columns = spec.schema.fieldNames()
        if buckets is None or sum(u.rows for u in units) > 4 * buckets * self.bucket_rows:
            rows = max(staging.count(), sum(u.rows for u in units))
            whole = upsert(self.read_units(spec, units), staging, spec.keys).result if units else staging.select(*columns).dropDuplicates()
            return self.stage(spec, whole, state.next_version(spec.name), state, rows)
        at = _bucket(spec, buckets)
        changed = staging.select(*columns).subtract(self.read_units(spec, units)).select(at.alias(BUCKET)).distinct()
        touched = sorted(r[0] for r in changed.collect())  # at most one row per bucket
        parts = {f"{BUCKET}={b}" for b in touched}
        old = self.read_units(spec, [u for u in units if u.part in parts])
        new = upsert(old, staging.where(at.isin(touched)), spec.keys).result
        return self._write(spec, new, state.next_version(spec.name), state, buckets, parts)

    def stage(self, spec: TableSpec, df: DataFrame, version: int, state: State | None = None, rows: int | None = None) -> StagedWrite:
        """Write ``df`` as an unpublished version (a new batch of the fact, the whole
        content of a dimension, of about ``rows`` rows), then check it."""
        state = state or self.state()
        published = state.versions.get(spec.name, [])
        if published and version <= published[-1]:
            raise ValueError(f"{spec.name}: version {version} is not after published {published[-1]}")
        if spec.insert_only:
            return self._write(spec, df, version, state, None, set())
        buckets = 1 << max(0, (-(-(df.count() if rows is None else rows) // self.bucket_rows) - 1).bit_length())
        return self._write(spec, df, version, state, buckets, {u.part for u in state.of(spec.name)})

    def _write(self, spec: TableSpec, df: DataFrame, version: int, state: State, buckets: int | None, dropped: set[str]) -> StagedWrite:
        """Write, then check what was written.

        Row count and content checksum are observed during the write itself and
        computed again from the files, so the checked data is what readers get.
        """
        attempt = uuid.uuid4().hex
        path = self.attempt_dir(spec, version, attempt)
        columns = spec.schema.fieldNames()
        if buckets is None:
            out, by = cluster_by_arrival_month(with_arrival_partition(df)), list(spec.partition_by)
        else:
            out, by = df.withColumn(BUCKET, _bucket(spec, buckets)).hint("rebalance", BUCKET), [BUCKET]
        metrics = write_parquet_observed(out, path, partition_by=by, extra_metrics=[content_checksum(columns)])
        stored = StructType([*spec.schema.fields, *(StructField(p, IntegerType()) for p in by)])
        written = self.spark.read.schema(stored).parquet(path)
        profile = key_profile(written, spec.keys).first()
        samples = []
        if profile["null_key_rows"]:
            # One offending row for the message (a limit-1 probe).
            row = null_key_sample(written.select(*columns), spec.keys)
            samples.append(f"null-key row: {row[0].asDict() if row else None}")
        if profile["duplicate_keys"]:
            some = duplicate_offenders(written, spec.keys).limit(3).collect()
            samples.append(f"duplicated keys: {[r.asDict() for r in some]}")
        units, content = self._units(spec, written, version, attempt, by)
        rows = int(metrics["rows"])
        filters = []
        if spec.insert_only and rows:
            filters = [KeyFilter(spec.name, version, attempt, filter_words(rows))]
            key_filter(written, spec.keys, filters[0].words).write.parquet(self.filter_dir(filters[0]))
        return StagedWrite(
            spec=spec,
            version=version,
            path=path,
            attempt=attempt,
            written_rows=rows,
            read_rows=int(profile["rows"]),
            null_key_rows=int(profile["null_key_rows"]),
            duplicate_keys=int(profile["duplicate_keys"]),
            content_equal=content == int(metrics["content"] or 0),
            base=state,
            units=units,
            dropped=dropped,
            filters=filters,
            buckets=buckets,
            samples=samples,
        )

    def _units(self, spec: TableSpec, written: DataFrame, version: int, attempt: str, by: list[str]) -> tuple[list[Unit], int]:
        """Units of written files, and the checksum of all their rows (one scan)."""
        file, size = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
        per_file = written.groupBy(*by, file, size).agg(F.count(F.lit(1)).alias("rows"), content_checksum(spec.schema.fieldNames()))
        per_part = per_file.groupBy(*by).agg(F.sum("rows").alias("rows"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("files"), F.sum("content").alias("content"))
        found = per_part.collect()  # one row per month or bucket
        units = [Unit(spec.name, version, attempt, "/".join(f"{p}={_folder(r[p])}" for p in by), r["rows"], r["bytes"], r["files"]) for r in found]
        return units, sum(int(r["content"]) for r in found)

    def publish(self, *staged: StagedWrite) -> None:
        """Make checked versions visible, all in one commit.

        The commit follows the state that the versions were staged from; if another
        run has published since, PublishConflict is raised and nothing is visible.
        """
        base = staged[0].base
        if any(s.base.number != base.number for s in staged):
            raise ValueError("the versions were staged from different states")
        out = base
        for s in staged:
            name = s.spec.name
            kept = [u for u in out.of(name) if u.part not in s.dropped or s.spec.insert_only]
            filters = [f for f in out.filters if f.table == name]
            out = out.with_table(name, s.version, [*kept, *s.units], [*filters, *s.filters], s.buckets)
        self.log.add(replace(out, number=base.number + 1))

    # -- maintenance ----------------------------------------------------------

    def compact(self, spec: TableSpec, file_bytes: int = FILE_BYTES) -> State:
        """Pack small month directories of the fact into files of about ``file_bytes``.

        Directories whose files average under half of that are taken. Within each
        month they are put into bins in order of batch, a bin closing at
        ``file_bytes``; a bin with a single file stays as it is. Each bin becomes one file of a
        new batch, which replaces its directories in one commit. Content does not change:
        it is compared by checksum before the commit. Rows move once, in one shuffle by bin.
        """
        state = self.state()
        small = [u for u in state.of(spec.name) if u.bytes < u.files * file_bytes / 2]
        bins: dict[str, list[list[Unit]]] = {}
        for u in sorted(small, key=lambda u: (u.part, u.version)):  # names of directories, no rows
            month = bins.setdefault(u.part, [[]])
            if month[-1] and sum(x.bytes for x in month[-1]) + u.bytes > file_bytes:
                month.append([])
            month[-1].append(u)
        packed = [b for month in bins.values() for b in month if sum(u.files for u in b) > 1]
        if not packed:
            return state
        moved = [u for b in packed for u in b]
        cuts = [-(-sum(u.bytes for u in b) // file_bytes) for b in packed]  # a directory of very many small files
        places = [(_attempt(u), u.part, sum(cuts[:k]), cuts[k]) for k, b in enumerate(packed) for u in b]
        where = self.spark.createDataFrame(places, "_attempt string, _part string, _first int, _cuts int")
        folder = F.regexp_extract("_metadata.file_path", r"batch=\d+/attempt=\w+", 0)
        month = F.concat_ws("/", *(F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit(_folder(None)))) for p in spec.partition_by))
        columns, order = spec.schema.fieldNames(), [*spec.partition_by, *spec.keys]
        rows = self._files(spec, moved).select(*columns, *spec.partition_by, folder.alias("_attempt"), month.alias("_part"))
        rows = rows.join(F.broadcast(where), ["_attempt", "_part"])  # one row per directory
        into = (F.col("_first") + F.pmod(F.xxhash64(*spec.keys), F.col("_cuts"))).cast("int")
        rows = rows.repartitionById(sum(cuts), into).sortWithinPartitions(*order).select(*columns, *spec.partition_by)
        version, attempt = state.next_version(spec.name), uuid.uuid4().hex
        path = self.attempt_dir(spec, version, attempt)
        metrics = write_parquet_observed(rows, path, partition_by=spec.partition_by, extra_metrics=[content_checksum(columns)])
        written = self.spark.read.schema(stored_columns(spec)).parquet(path)
        units, content = self._units(spec, written, version, attempt, list(spec.partition_by))
        if content != int(metrics["content"]) or sum(u.rows for u in units) != sum(u.rows for u in moved):
            raise RuntimeError(f"{spec.name}: compacted rows differ from the rows read; nothing was changed")
        keys = KeyFilter(spec.name, version, attempt, filter_words(sum(u.rows for u in units)))
        key_filter(written, spec.keys, keys.words).write.parquet(self.filter_dir(keys))
        gone = set(moved)
        left = [u for u in state.of(spec.name) if u not in gone]
        held = {(u.version, u.attempt) for u in left}
        filters = [f for f in state.filters if f.table == spec.name and (f.version, f.attempt) in held]
        out = replace(state.with_table(spec.name, version, [*left, *units], [*filters, keys]), number=state.number + 1)
        self.log.add(out)
        return out

    def retire(self, keep: int = 2, older_than_s: float = 7 * 24 * 3600) -> list[str]:
        """Remove commits before the last ``keep``, and directories that no kept commit
        names. Directories changed in the last ``older_than_s`` seconds stay: a run may be
        staging them. Returns the removed directories."""
        numbers = self.log.numbers()
        kept = [self.log.read(n) for n in numbers[-keep:]]
        named = {f"{u.table}/{_attempt(u)}" for s in kept for u in s.units}
        named |= {self.filter_dir(f).removeprefix(f"{self.root}/") for s in kept for f in s.filters}
        for n in numbers[:-keep]:
            self.log.remove(n)
        return self.log.remove_folders(self.root, ["*/*=*/attempt=*", "_keys/*/*=*/*=*/attempt=*"], named, older_than_s)


def _bucket(spec: TableSpec, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*spec.keys), F.lit(buckets)).cast("int")


def _folder(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


def _attempt(u: Unit) -> str:
    return f"{'version' if u.part.startswith(f'{BUCKET}=') else 'batch'}={u.version}/attempt={u.attempt}"
