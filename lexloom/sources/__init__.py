"""Scans, sinks and staged tables."""

from lexloom.sources.readers import (
    read_csv,
    read_parquet,
    read_words,
    spread,
    with_slice,
)
from lexloom.sources.sinks import append_csv, append_json, write_parquet
from lexloom.sources.staging import Staging, shared_dir, stage

__all__ = [
    "Staging",
    "append_csv",
    "append_json",
    "read_csv",
    "read_parquet",
    "read_words",
    "shared_dir",
    "spread",
    "stage",
    "with_slice",
    "write_parquet",
]
