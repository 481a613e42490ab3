"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _canonical_sql(name: str, dtype: T.DataType) -> str:
    """A text from which the value can be told again, whatever follows it.

    Strings: the length, a colon and the string, or a dash for NULL.  Other
    types: their text, which has no bar, and a bar; nothing before the bar
    for NULL.  The text of a double is the one that reads back as the same
    double (NaN and the infinities have their own); -0.0 is 0.0, as in
    grouping."""
    c = f"`{name}`"
    if isinstance(dtype, T.StringType):
        return f"coalesce(concat(length({c}), ':', {c}), '-')"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = f"({c} + 0.0D)"
    return f"coalesce(CAST({c} AS STRING), ''), '|'"


KEY_HEX_CHARS = 32   # 128 bits


def stable_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """First 128 bits (32 hex characters) of SHA-256 over the business
    columns, written so that different rows never give the same text
    (``_canonical_sql``).

    Unlike ``monotonically_increasing_id`` the value depends only on the row,
    so reruns, retries after executor loss and other engines give the same
    key.  Rows must be de-duplicated on ``columns`` first for it to be unique;
    two distinct rows share a key with probability about n^2 / 2^129
    (1e-15 for 10^12 rows).  128 bits instead of 256 halves the key, which is
    most of the fact table's bytes (random hex does not compress).
    """
    return key_of_texts(key_text(df, columns))


def key_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """The text of ``columns`` that ``stable_key`` hashes.  Texts of the parts of a joined row, in order, make up the
    row's text, so that each is built once, before the join repeats it.
    Built as one SQL expression (one JVM call instead of one per column part)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return F.expr(f"concat({', '.join(_canonical_sql(c, types[c]) for c in columns)})")


def key_of_texts(*texts: Column) -> Column:
    """``stable_key`` of a row whose parts have these texts."""
    return F.substring(F.sha2(F.concat(*texts), 256), 1, KEY_HEX_CHARS)


def monotonic_key() -> Column:
    """Unique per row but dependent on partitioning (not stable across runs)."""
    return F.monotonically_increasing_id()


def row_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Two independent 64-bit hashes of the row (128 bits together).

    Equal rows always get equal fingerprints; different rows collide with
    probability about n^2 / 2^129, negligible even for 10^12 rows.  Grouping
    on the fingerprint shuffles 16 bytes per row whatever the row width.
    ``xxhash64`` skips NULL inputs, so each column is paired with its NULL
    flag; -0.0 is folded into 0.0 (``+ 0.0``) as grouping does.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    parts = []
    for c in (columns or df.columns):
        col = f"`{c}`"
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            col = f"({col} + 0.0D)"
        parts += [col, f"isnull({col})"]
    args = ", ".join(parts)
    return [F.expr(f"xxhash64({args})").alias("__fp1"),
            F.expr(f"xxhash64('climastar-fp', {args})").alias("__fp2")]
