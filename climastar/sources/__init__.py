"""Readers, writers, table contracts and the driver-table stand-ins."""

from climastar.sources.readers import (
    read_csv_strings, read_demographics_json, read_json, read_parquet, source_path,
)
from climastar.sources.sinks import write_parquet_overwrite

__all__ = [
    "read_csv_strings", "read_demographics_json", "read_json", "read_parquet",
    "source_path", "write_parquet_overwrite",
]
