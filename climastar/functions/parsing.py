"""Parsing of text fields: split items, dates, hemisphere coordinates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climastar.functions.casts import ColumnOrName, _col, to_decimal, to_float, to_int


def split_part(c: ColumnOrName, sep: str, index: int) -> Column:
    """0-based item of ``split(c, sep)``; NULL when the item is missing.

    ``F.get`` returns NULL past the end, where ``[]`` raises under ANSI mode.
    ``sep`` is a regular expression, as in ``split``.
    """
    return F.get(F.split(_col(c), sep), index)


def date_year(c: ColumnOrName) -> Column:
    """Year of a ``yyyy-MM-dd`` text, as int."""
    return to_int(split_part(c, "-", 0))


def date_month(c: ColumnOrName) -> Column:
    """Month of a ``yyyy-MM-dd`` text, as int ('01' -> 1, '1849' -> NULL)."""
    return to_int(split_part(c, "-", 1))


def hemisphere_coordinate(c: ColumnOrName, precision: int = 9, scale: int = 2) -> Column:
    """``'45.81S'`` -> -45.81: number before the last character, negative for
    a trailing S or W, as decimal(9, 2).  NULL, empty or malformed -> NULL.

    The number passes through a 4-byte float as in the source job, so the
    decimal rounding matches its results.
    """
    x = _col(c)
    body = to_float(F.substring(x, F.lit(1), F.length(x) - 1))
    sign = F.when(x.rlike("[SW]$"), F.lit(-1)).otherwise(F.lit(1))
    return to_decimal(body * sign, precision, scale)


@F.pandas_udf(T.FloatType())
def hemisphere_pandas(s: pd.Series) -> pd.Series:
    """Vectorised Python twin of the native expression (tests only)."""
    body = pd.to_numeric(s.str.slice(0, -1), errors="coerce").astype("float32")
    sign = s.str.slice(-1).isin(["S", "W"]).map({True: -1.0, False: 1.0})
    return (body * sign).astype("float32")


def hemisphere_coordinate_udf(c: ColumnOrName, precision: int = 9, scale: int = 2) -> Column:
    """Same result as ``hemisphere_coordinate`` through the pandas twin."""
    return to_decimal(hemisphere_pandas(_col(c)), precision, scale)
