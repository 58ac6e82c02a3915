"""Relational operators: joins with checked broadcast, merges, de-duplication,
roll-ups and key checks."""

from starmart.operators.dedup import distinct_rows, grouped_average, last_value, row_counts
from starmart.operators.joins import anti_join, fits, lookup_join, maybe_broadcast
from starmart.operators.merge import Merge, insert_only, upsert
from starmart.operators.quality import (
    check_report,
    duplicate_offenders,
    key_profile,
    null_key_count,
    null_key_rows,
    null_key_sample,
    read_back,
    report_rows,
    write_parquet_observed,
)

__all__ = [
    "Merge",
    "anti_join",
    "check_report",
    "distinct_rows",
    "duplicate_offenders",
    "fits",
    "grouped_average",
    "insert_only",
    "key_profile",
    "last_value",
    "lookup_join",
    "maybe_broadcast",
    "null_key_count",
    "null_key_rows",
    "null_key_sample",
    "read_back",
    "report_rows",
    "row_counts",
    "upsert",
    "write_parquet_observed",
]
