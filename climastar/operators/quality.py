"""Data-quality operators.  Each returns a DataFrame computed from the data
it checks (one aggregate pass per table), so the checks scale with the
tables and can be written or joined like any other result."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climastar.functions.digests import content_sums
from climastar.functions.keys import row_fingerprint
from climastar.sources.contracts import conform, constraint_rules
from climastar.sources.sinks import Receipt


class EmptySourceError(RuntimeError):
    """A source produced no rows; the job must stop with a failure."""


def ensure_non_empty(df: DataFrame, name: str) -> DataFrame:
    """Raise when ``df`` has no row.  ``isEmpty`` stops at the first row
    found, unlike ``count() == 0``.  (The source job printed and exited with
    status 0, so a failed gate looked like success.)"""
    if df.isEmpty():
        raise EmptySourceError(f"{name}: no rows to process")
    return df


def non_empty_flags(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(source, non_empty) per table.

    Each flag comes from ``isEmpty``, an incremental take: it reads one
    partition first and widens only while nothing is found.  (A ``limit(1)``
    inside an aggregate would start one task on every split of the input.)
    The result has one row per table.
    """
    if not tables:
        raise ValueError("no tables to check")
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, not df.isEmpty()) for name, df in tables.items()]
    return spark.createDataFrame(rows, "source string, non_empty boolean")


def constraint_violations(df: DataFrame, table: str) -> DataFrame:
    """Violations of the declared NOT NULL and ``varchar(n)`` rules of
    ``table`` after conforming ``df`` to it: rows (table, column, rule,
    max_length, violations).  One aggregate pass evaluates every rule.

    Needed because a Parquet table accepts NULL in a NOT NULL column and a
    cast to ``varchar(n)`` does not truncate.
    """
    rules = constraint_rules(table)
    c = conform(df, table)
    sums = []
    for i, r in enumerate(rules):
        col = F.col(f"`{r.column}`")
        bad = col.isNull() if r.rule == "not_null" else (F.length(col) > F.lit(r.limit))
        sums.append(F.sum(F.when(bad, 1).otherwise(0)).cast("long").alias(f"v{i}"))
    agg = c.agg(*sums)
    rows = F.array(*[
        F.struct(F.lit(r.table).alias("table"), F.lit(r.column).alias("column"),
                 F.lit(r.rule).alias("rule"),
                 F.lit(r.limit).cast(T.IntegerType()).alias("max_length"),
                 F.coalesce(F.col(f"v{i}"), F.lit(0).cast("long")).alias("violations"))
        for i, r in enumerate(rules)])
    return agg.select(F.inline(rows))


def duplicate_summary(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(table, rows, distinct_rows, duplicates, passed) over ``columns``.

    Rows are grouped on a 128-bit fingerprint of ``columns``
    (``functions.keys.row_fingerprint``), so the shuffle carries 16 bytes
    per row instead of every column.  Grouping has a partial phase: copies
    of one row collapse inside each map task, so even a row repeated across
    a third of the table shuffles little.
    """
    grouped = (df.select(*row_fingerprint(df, columns))
               .groupBy("__fp1", "__fp2").agg(F.count(F.lit(1)).alias("__n")))
    return grouped.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("rows"),
        F.count(F.lit(1)).cast("long").alias("distinct_rows"),
    ).select(
        F.lit(table).alias("table"), "rows", "distinct_rows",
        (F.col("rows") - F.col("distinct_rows")).alias("duplicates"),
        (F.col("rows") == F.col("distinct_rows")).alias("passed"),
    )


def long_key_summary(df: DataFrame, key: str) -> DataFrame:
    """(rows, distinct_ids) over a bigint ``key``, exact for any values; NULL is one value.

    Keys are grouped by their upper 58 bits, and the lower six set a bit of a
    64-bit mask, whose bits are then counted.  Where keys run on, as those of
    ``monotonically_increasing_id`` do, 64 rows make one group inside their
    map task, so that the shuffle has one row for 64.
    """
    k = F.col(f"`{key}`")
    masks = df.groupBy(F.shiftright(k, 6).alias("high")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_or(F.expr(f"shiftleft(1L, CAST(`{key}` & 63 AS INT))")).alias("mask"))
    ids = F.coalesce(F.bit_count("mask"), F.lit(1)).cast("long")
    return masks.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"), F.coalesce(F.sum(ids), F.lit(0)).cast("long").alias("distinct_ids"))


def row_count_match(table: str, rows_written: int, read_back: DataFrame) -> DataFrame:
    """(table, rows_written, rows_read, passed) for one written table."""
    return read_back.agg(F.count(F.lit(1)).cast("long").alias("rows_read")).select(
        F.lit(table).alias("table"),
        F.lit(rows_written).cast("long").alias("rows_written"),
        "rows_read",
        (F.col("rows_read") == F.lit(rows_written).cast("long")).alias("passed"),
    )


def content_match(table: str, written: Receipt, read_back: DataFrame) -> DataFrame:
    """(table, rows_written, rows_read, passed) for one written table: ``passed`` if what is read back is the same multiset
    of rows, by the digest observed during the write.  Equal counts with one changed value fail."""
    return read_back.agg(*content_sums(read_back)).select(
        F.lit(table).alias("table"), F.lit(written.rows).cast("long").alias("rows_written"), F.col("rows").alias("rows_read"),
        ((F.col("rows") == written.rows) & (F.col("sum1") == written.sum1) & (F.col("sum2") == written.sum2)).alias("passed"))


def file_manifest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, bytes, rows, digest) of every Parquet file under ``path``; rows and digest are NULL if nothing of it could be decoded.

    The files are listed with their size; every column of every row is
    decoded and digested, grouped by the file that Spark's metadata column
    names.  A damaged file ends early or gives no rows instead of failing the
    others.  ``file`` is the path below ``path``.
    """
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
              .select("path", F.col("length").alias("bytes")))
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(path)
    one, two = row_fingerprint(rows, [f.name for f in schema.fields])
    marked = rows.select(F.col("_metadata.file_path").alias("of"), one, two)
    total = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("__fp1", "__fp2")]
    decoded = (marked.groupBy("of").agg(F.count(F.lit(1)).alias("rows"), *total)
               .select("of", "rows", F.concat_ws(":", "rows", "__fp1", "__fp2").alias("digest")))
    # Both name a file by its URI, which may have one or three slashes after the scheme.
    name = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/+", "/")                          # noqa: E731
    root = path.split(":", 1)[-1].rstrip("/") if ":" in path.split("/", 1)[0] else path.rstrip("/")
    short = F.expr(f"substring(file, {len('/' + root.lstrip('/')) + 2})")
    return (listed.join(decoded, name(F.col("path")) == name(F.url_decode("of")), "left")
            .select(name(F.col("path")).alias("file"), "bytes", "rows", "digest").withColumn("file", short))


def audit_files(manifest: DataFrame, now: DataFrame) -> DataFrame:
    """(file, bytes, rows, rows_expected, status) of every file of either manifest (see ``file_manifest``): ``ok``, ``damaged`` (other rows
    than written, or none that can be decoded), ``missing`` or ``added``."""
    was = manifest.select(F.col("file").alias("was_file"), F.col("rows").alias("rows_expected"), F.col("digest").alias("was_digest"))
    both = was.join(now, F.col("was_file") == F.col("file"), "full_outer")
    status = (F.when(F.col("file").isNull(), "missing").when(F.col("was_file").isNull(), "added")
              .when(F.col("digest").eqNullSafe(F.col("was_digest")), "ok").otherwise("damaged"))
    return both.select(F.coalesce("file", "was_file").alias("file"), "bytes", "rows", "rows_expected", status.alias("status"))


def readable(spark: SparkSession, tables: Mapping[str, str], expected: Mapping[str, T.StructType]) -> DataFrame:
    """(table, readable, schema_matches, rows_decoded) of written tables
    (name -> path): the schema is that of the files' footers, and every
    column of every row is decoded.

    A file that cannot be read gives ``readable`` false instead of an error;
    columns of another name, type or number give ``schema_matches`` false.
    """
    out = []
    for name, path in tables.items():
        want = [(f.name, f.dataType.simpleString()) for f in expected[name].fields]
        try:
            df = spark.read.option("mergeSchema", True).parquet(path)
            got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
            digest = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
            n = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(digest).alias("decoded")).first().n
            out.append((name, True, got == want, n))
        except Exception as e:
            logging.getLogger(__name__).warning("table %s at %s cannot be read: %s", name, path, e)
            out.append((name, False, False, 0))
    return spark.createDataFrame(out, "table string, readable boolean, schema_matches boolean, rows_decoded long")


def qa_report(rows_written: Mapping[str, int], tables: Mapping[str, DataFrame],
              dedup_columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Union of the round-trip row-count check and the duplicate check:
    (table, check, expected, actual, passed)."""
    parts = []
    for name, df in tables.items():
        parts.append(row_count_match(name, rows_written[name], df).select(
            "table", F.lit("row_count").alias("check"),
            F.col("rows_written").alias("expected"), F.col("rows_read").alias("actual"), "passed"))
        parts.append(duplicate_summary(df, name, dedup_columns.get(name)).select(
            "table", F.lit("duplicates").alias("check"),
            F.lit(0).cast("long").alias("expected"), F.col("duplicates").alias("actual"), "passed"))
    return _union(parts)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
