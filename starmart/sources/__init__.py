"""Sources: typed Parquet/CSV readers, code-list extraction, staging load."""

from starmart.sources.labels import code_list, label_blocks, label_entries, last_wins
from starmart.sources.readers import read_csv, read_parquet
from starmart.sources.staging import ContractError, enforce_contract, load_staging

__all__ = [
    "ContractError",
    "code_list",
    "enforce_contract",
    "label_blocks",
    "label_entries",
    "last_wins",
    "load_staging",
    "read_csv",
    "read_parquet",
]
