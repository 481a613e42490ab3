"""Projections: rename, drop."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename in one plan node.  Names resolve case-insensitively and a name
    the input lacks is skipped, so one mapping serves several spellings."""
    return df.withColumnsRenamed(dict(mapping))


def drop(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)
