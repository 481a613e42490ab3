"""Tolerant casts.

The source job ran with ANSI mode off, where a malformed value becomes NULL
and text such as ``'12.7'`` truncates to ``12`` when cast to an integer.
Spark 4 defaults to ANSI mode, where the same casts raise.  These helpers
reproduce the lenient results with ``try_cast`` so that the session can keep
its ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: ColumnOrName) -> Column:
    """Text or number to double; malformed -> NULL ('NaN' stays NaN)."""
    return _col(c).try_cast(T.DoubleType())


def to_float(c: ColumnOrName) -> Column:
    """Text or number to 4-byte float; malformed -> NULL."""
    return _col(c).try_cast(T.FloatType())


def _integral(c: ColumnOrName, target: T.DataType) -> Column:
    # via an exact decimal: '12.7' -> 12, '-12.7' -> -12, ' 7 ' -> 7 and every
    # bigint unchanged; NaN, overflow and text such as '12d' -> NULL
    return _col(c).try_cast(T.DecimalType(38, 18)).try_cast(target)


def to_int(c: ColumnOrName) -> Column:
    return _integral(c, T.IntegerType())


def to_long(c: ColumnOrName) -> Column:
    return _integral(c, T.LongType())


def to_decimal(c: ColumnOrName, precision: int = 9, scale: int = 2) -> Column:
    """Number or text to decimal(p, s); overflow -> NULL."""
    return _col(c).try_cast(T.DecimalType(precision, scale))


def to_text(c: ColumnOrName) -> Column:
    """Cast to string.  A declared ``varchar(n)`` does not truncate, exactly
    like the source job's ``cast('varchar(n)')``; lengths are checked by the
    constraint report instead (``operators.quality``)."""
    return _col(c).cast(T.StringType())


def tolerant_cast(c: ColumnOrName, dtype: T.DataType) -> Column:
    """Dispatch on the target type."""
    if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
        return _integral(c, dtype)
    if isinstance(dtype, T.LongType):
        return to_long(c)
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return to_text(c)
    return _col(c).try_cast(dtype)
