"""Row filters.  Plain comparisons on source columns, so Catalyst pushes them
into the scan (``PushedFilters``) and through joins of the stand-in views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """Exact, case-sensitive equality; NULL never matches."""
    return df.filter(F.col(f"`{column}`") == F.lit(value))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL or NaN in any of ``columns`` (``dropna``)."""
    return df.dropna(subset=list(columns))
