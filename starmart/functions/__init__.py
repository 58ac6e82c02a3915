"""Column-level functions: dates, casts, renames. All built-in Spark expressions."""

from starmart.functions.casts import (
    cast_columns,
    reject_counts,
    rename_columns,
    strip,
)
from starmart.functions.dates import (
    compact_date,
    epoch_day_to_date,
    month_name_to_number,
)

__all__ = [
    "cast_columns",
    "compact_date",
    "epoch_day_to_date",
    "month_name_to_number",
    "reject_counts",
    "rename_columns",
    "strip",
]
