"""Aggregations.  All are declarative aggregates with a partial (map-side)
phase, so a key that holds a third of the rows is reduced inside every map
task before anything is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame], by_key: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per table: (table, rows).

    ``by_key`` has, for tables that are joins, the rows of each key in a column
    ``rows``: the product of the counts of the joined parts.  Their sum is the
    count of the joined rows, which need not be formed for it."""
    by_key = by_key or {}
    counts = {name: by_key[name].agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows")) if name in by_key
              else df.agg(F.count(F.lit(1)).alias("rows")) for name, df in tables.items()}
    parts = [df.select(F.lit(name).alias("table"), "rows") for name, df in counts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_by(value: str, order: Sequence[str]) -> Column:
    """Deterministic "first": the value of the row least in ``order``.

    ``first()`` without an order returns whichever row a task saw first, so
    a city name that spans two states gave either state's value.  Here the
    row least in ``order`` (NULLs first) wins, the value itself breaking
    ties.  NULL values are returned, not skipped, as ``first()`` does.
    """
    return F.min_by(F.col(f"`{value}`"),
                    F.struct(*[F.col(f"`{c}`") for c in order], F.col(f"`{value}`")))


def first_per_group(df: DataFrame, key: str, value: str, order: Sequence[str],
                    alias: str | None = None) -> DataFrame:
    return df.groupBy(F.col(f"`{key}`")).agg(first_by(value, order).alias(alias or value))


def distinct_count_per_group(df: DataFrame, key: str, column: str, alias: str) -> DataFrame:
    """Exact distinct count of ``column`` per ``key``; NULL not counted."""
    return df.groupBy(F.col(f"`{key}`")).agg(F.count_distinct(F.col(f"`{column}`")).alias(alias))


def dedup(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-row de-duplication over ``columns`` (all when None).

    Projects first, so the result is deterministic; ``dropDuplicates(subset)``
    would keep an arbitrary row for the other columns.
    """
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    return df.dropDuplicates()
