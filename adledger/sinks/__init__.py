"""Writers."""

from .writers import (
    by_run, read_if_exists, write_files, write_if_absent, write_index, write_jsonl, write_run_outputs,
    write_table_csv,
)

__all__ = [
    "by_run", "read_if_exists", "write_files", "write_if_absent", "write_index", "write_jsonl",
    "write_run_outputs", "write_table_csv",
]
