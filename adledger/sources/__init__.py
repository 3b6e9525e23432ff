"""Readers. Explicit schemas; run ids come from file paths and stay text."""

from .artifacts import artifact_inventory, read_importance, read_run_metrics
from .packed import pack_files, read_packed_jsonl, read_packed_texts
from .pages import read_pages
from .records import read_jsonl
from .tables import read_table_csv
from .texts import list_runs, read_run_texts

__all__ = [
    "artifact_inventory", "list_runs", "pack_files", "read_importance", "read_jsonl", "read_packed_jsonl",
    "read_packed_texts", "read_pages", "read_run_metrics", "read_run_texts", "read_table_csv",
]
