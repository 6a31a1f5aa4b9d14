"""Scans and sinks."""

from mergewright.sources.scans import require_columns, scan_text, scan_typed, spread
from mergewright.sources.sinks import write_csv, write_json, write_splits
from mergewright.sources.staging import shared_folder, stage

__all__ = ["require_columns", "scan_text", "scan_typed", "shared_folder", "spread", "stage", "write_csv",
           "write_json", "write_splits"]
