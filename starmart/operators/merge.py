"""Merges of a staging batch into a published table.

* ``insert_only``: result = target + distinct(staging rows whose key is absent
  from target). Existing rows never change.
* ``upsert``: type-1 upsert on any key list. result = (target rows whose key
  is absent from staging) + distinct(staging). Unmatched target rows stay.

Staging is de-duplicated on whole rows (two different rows with one key are
both kept, and the key checks flag them before anything is published).

Plans. When the staging keys are proven small (rows and bytes) the big target
is never shuffled: for the upsert the staging keys are broadcast into an anti
join that streams the target; for the insert the target's key column is
streamed through a broadcast semi join to find the few matched keys, which are
then broadcast into the anti join of staging. Beyond the bound both become
sort-merge joins on the keys (AQE splits skewed key ranges). Only key columns
of the target are read to decide membership.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, anti_join, fits


@dataclass
class Merge:
    """The two parts of a merge; ``result`` is their bag union."""

    kept: DataFrame
    inserted: DataFrame
    target: DataFrame

    @property
    def result(self) -> DataFrame:
        return self.kept.unionByName(self.inserted)

    def stats(self, table_name: str) -> DataFrame:
        """One row: table_name, rows_before, inserted, replaced, rows_after.

        One job: the three inputs are scanned without columns and summed.
        """
        one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        tally = (
            self.target.select(one.alias("b"), zero.alias("i"), zero.alias("k"))
            .unionByName(self.inserted.select(zero.alias("b"), one.alias("i"), zero.alias("k")))
            .unionByName(self.kept.select(zero.alias("b"), zero.alias("i"), one.alias("k")))
            .agg(
                F.coalesce(F.sum("b"), zero).alias("rows_before"),
                F.coalesce(F.sum("i"), zero).alias("inserted"),
                F.coalesce(F.sum("k"), zero).alias("kept"),
            )
        )
        return tally.select(
            F.lit(table_name).alias("table_name"),
            "rows_before",
            "inserted",
            (F.col("rows_before") - F.col("kept")).alias("replaced"),
            (F.col("kept") + F.col("inserted")).alias("rows_after"),
        )


def _not_null(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def _probe_batch(
    target: DataFrame, batch_keys: DataFrame, keys: list[str], max_rows: int
) -> tuple[bool, DataFrame]:
    """One small job over the batch keys: is the batch small, and which key
    range can match?

    For a single numeric key the target's key scan is limited to the batch's
    [min, max]. The filter only prunes (rows outside cannot match); it reaches
    the Parquet scan, where row-group min/max statistics skip whole files of
    older ids.
    """
    target_keys = target.select(*keys)
    numeric = len(keys) == 1 and dict(batch_keys.dtypes)[keys[0]] in (
        "tinyint", "smallint", "int", "bigint", "float", "double", "date",
    )
    if not numeric:
        return fits(batch_keys, max_rows), target_keys
    k = keys[0]
    n, lo, hi = batch_keys.agg(F.count(F.lit(1)), F.min(k), F.max(k)).first()
    if n == 0:
        return True, target_keys.where(F.lit(False))
    return n <= max_rows, target_keys.where(F.col(k).between(F.lit(lo), F.lit(hi)))


def insert_only(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> Merge:
    """Insert staging rows whose key the target does not hold yet."""
    keys = list(keys)
    staged = staging.select(*target.columns).dropDuplicates()
    batch_keys = staging.select(*keys).where(_not_null(keys))
    small, target_keys = _probe_batch(target, batch_keys, keys, max_broadcast_rows)
    if small:
        # Stream the target's key column once through a broadcast of the batch
        # keys; the matches are at most the batch's distinct keys.
        matched = (
            target_keys.join(F.broadcast(batch_keys), keys, "left_semi")
            .distinct()
        )
        new = staged.join(F.broadcast(matched), keys, "left_anti")
    else:
        # Large batch: sort-merge anti join; the target side is still only the
        # key column, pruned to the batch's key range.
        new = staged.join(target_keys.where(_not_null(keys)), keys, "left_anti")
    return Merge(kept=target, inserted=new, target=target)


def upsert(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> Merge:
    """Type-1 upsert: staging rows replace target rows with an equal key.

    Keys compare with ``=``: a null key matches nothing, so a staging row with
    a null key is inserted on every run. Staging frames loaded through the
    table contract (``load_staging``) cannot hold one.
    """
    keys = list(keys)
    staged = staging.select(*target.columns).dropDuplicates()
    # Membership needs the batch keys only, not its de-duplicated rows.
    kept = anti_join(target, staging, keys, max_broadcast_rows)
    return Merge(kept=kept, inserted=staged, target=target)
