"""Incremental fact loads with Structured Streaming.

Raw arrival files land month by month (or day by day) in one folder. A file
stream picks up only files it has not seen (tracked in the checkpoint), and
each micro-batch goes through the same path as a batch run: the fact
projection, the staging contract, the insert-only merge against the published
fact, the checks, and the commit that publishes the new batch.

Replays are safe: a micro-batch that failed before its commit is staged
again; one that failed after is merged
again against a fact that already holds its keys, so it inserts nothing.
``trigger(availableNow=True)`` drains what has landed and stops, which makes
the stream a scheduled job; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starmart.plans.publish import TableStore
from starmart.plans.stages import CheckFailed
from starmart.plans.tables import fact_columns
from starmart.schemas import FACT, RAW_FACT_SCHEMA
from starmart.sources.staging import enforce_contract


def merge_fact_batch(store: TableStore, batch: DataFrame) -> int | None:
    """Merge one batch of fact rows; returns the published version (None if empty)."""
    staged = store.stage_insert(FACT, enforce_contract(batch, FACT), store.state())
    if staged.problems:
        raise CheckFailed(f"fact batch {staged.version}: {staged.problems}")
    if staged.written_rows == 0:
        return None
    store.publish(staged)
    return staged.version


def start_fact_increments(
    spark: SparkSession,
    raw_dir: str,
    store: TableStore,
    checkpoint_dir: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the file stream that merges new raw arrival files into the fact."""
    reader = spark.readStream.schema(RAW_FACT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    facts = reader.parquet(raw_dir).select(*fact_columns())

    def each_batch(batch: DataFrame, batch_id: int) -> None:  # noqa: ARG001
        merge_fact_batch(store, batch)

    writer = facts.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
