"""Declared warehouse tables: schema contracts, conform, reset.

The column lists below are the declared warehouse tables of the source
project, kept as plain data.  ``conform`` maps any DataFrame onto a contract
(select in declared order, tolerant cast, NULL for a missing column) and
``constraint_rules`` lists the NOT NULL and ``varchar(n)`` rules that the
quality report counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climastar.functions.casts import tolerant_cast

# Declared warehouse tables, columns in declared order as
# (name, declared type, NOT NULL).  The airport name column is spelled
# ``airport_name`` (the declared DDL misspells it), matching what the job
# writes.
CONTRACTS: dict[str, list[tuple[str, str, bool]]] = {
    "cities_demog": [
        ("city", "varchar(256)", False),
        ("state", "varchar(256)", False),
        ("median_age", "float", False),
        ("male_population", "int", False),
        ("female_population", "int", False),
        ("total_population", "int", False),
        ("veteran_population", "int", False),
        ("foreign_born", "int", False),
        ("ave_household_size", "float", False),
        ("state_code", "varchar(2)", False),
        ("race", "varchar(256)", False),
        ("count", "int", False),
    ],
    "airport_codes": [
        ("ident", "varchar(5)", False),
        ("type", "varchar(256)", False),
        ("airport_name", "varchar(256)", False),
        ("elevation_ft", "int", False),
        ("continent", "varchar(256)", False),
        ("iso_country", "varchar(2)", False),
        ("iso_region", "varchar(5)", False),
        ("municipality", "varchar(256)", False),
        ("gps_code", "varchar(4)", False),
        ("iata_code", "varchar(256)", False),
        ("local_code", "varchar(4)", False),
        ("latitude", "float", False),
        ("longitude", "float", False),
    ],
    "immigration": [
        ("cicid", "int8", False),
        ("i94yr", "int4", False),
        ("i94mon", "int2", False),
        ("i94cit", "int", False),
        ("i94res", "int", False),
        ("i94port", "varchar", False),
        ("arrdate", "int", False),
        ("i94mode", "int", False),
        ("i94addr", "varchar", False),
        ("depdate", "int", False),
        ("i94bir", "int", False),
        ("i94visa", "int", False),
        ("count", "int", False),
        ("dtadfile", "int", False),
        ("visapost", "varchar", False),
        ("occup", "varchar", False),
        ("entdepa", "varchar(1)", False),
        ("entdepd", "varchar(1)", False),
        ("entdepu", "varchar", False),
        ("matflag", "varchar(1)", False),
        ("biryear", "int", False),
        ("dtaddto", "int", False),
        ("gender", "varchar(1)", False),
        ("insnum", "varchar", False),
        ("airline", "varchar", False),
        ("admnum", "int8", False),
        ("fltno", "varchar", False),
        ("visatype", "varchar(2)", False),
    ],
    "city_surface_temps": [
        ("year", "int", False),
        ("mon", "int", False),
        ("average_temperature", "float", True),
        ("average_temperature_uncertainty", "float", False),
        ("city", "varchar(256)", False),
        ("country", "varchar(256)", False),
        ("latitude", "varchar(256)", False),
        ("longitude", "varchar(256)", False),
    ],
    "state_surface_temps": [
        ("year", "int", False),
        ("mon", "int", False),
        ("average_temperature", "float", True),
        ("average_temperature_uncertainty", "float", False),
        ("state", "varchar(256)", False),
        ("country", "varchar(256)", False),
    ],
}

_VARCHAR = re.compile(r"varchar\((\d+)\)")


def spark_type(declared: str) -> T.DataType:
    """Declared warehouse type to Spark type.  The warehouse ``float`` is an
    8-byte float, hence ``DoubleType``; ``varchar(n)`` becomes string and its
    length becomes a rule."""
    d = declared.lower()
    if d in ("int8", "bigint"):
        return T.LongType()
    if d in ("int", "int4", "integer"):
        return T.IntegerType()
    if d in ("int2", "smallint"):
        return T.ShortType()
    if d in ("float", "float8", "double precision"):
        return T.DoubleType()
    if d.startswith("varchar") or d in ("text", "string"):
        return T.StringType()
    raise ValueError(f"unknown declared type {declared!r}")


def contract_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, spark_type(t), not nn)
                         for c, t, nn in CONTRACTS[table]])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the contract's columns in order with tolerant casts; a column
    the input lacks becomes a typed NULL."""
    have = {f.name.lower(): f.name for f in df.schema.fields}
    cols = []
    for name, declared, _ in CONTRACTS[table]:
        dtype = spark_type(declared)
        src = have.get(name.lower())
        expr = tolerant_cast(F.col(f"`{src}`"), dtype) if src else F.lit(None).cast(dtype)
        cols.append(expr.alias(name))
    return df.select(*cols)


@dataclass(frozen=True)
class Rule:
    table: str
    column: str
    rule: str          # "not_null" or "max_length"
    limit: int | None  # the n of varchar(n)


def constraint_rules(table: str) -> list[Rule]:
    rules = []
    for name, declared, not_null in CONTRACTS[table]:
        if not_null:
            rules.append(Rule(table, name, "not_null", None))
        m = _VARCHAR.fullmatch(declared.lower())
        if m:
            rules.append(Rule(table, name, "max_length", int(m.group(1))))
    return rules


def _ddl_type(declared: str) -> str:
    d = declared.lower()
    if _VARCHAR.fullmatch(d):
        return d.upper()
    return spark_type(declared).simpleString().upper()


def create_table_sql(table: str, database: str) -> str:
    cols = ", ".join(f"`{c}` {_ddl_type(t)}{' NOT NULL' if nn else ''}" for c, t, nn in CONTRACTS[table])
    return f"CREATE TABLE `{database}`.`{table}` ({cols}) USING parquet"


def reset_tables(spark: SparkSession, tables: list[str], base: str, database: str) -> None:
    """Drop the named tables of ``database`` if present and create them empty.

    The database is one of its own, under ``base``; tables of the same name
    elsewhere are not touched.  Its tables are managed, so a drop also
    removes their files and a reset leaves nothing behind.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{base.rstrip('/')}/{database}.db'")
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{t}`")
        spark.sql(create_table_sql(t, database))


def load_table(df: DataFrame, table: str, database: str) -> None:
    """Append ``df``, conformed to the contract, into the catalog table.
    Spark enforces the declared ``varchar(n)`` lengths on this insert; a NULL
    in a NOT NULL column, which Parquet would accept, fails the load."""
    rows = conform(df, table)
    required = {c for c, _, not_null in CONTRACTS[table] if not_null}
    checked = [F.when(F.col(f"`{c}`").isNull(), F.raise_error(F.lit(f"NULL in {table}.{c}"))).otherwise(F.col(f"`{c}`")).alias(c)
               if c in required else F.col(f"`{c}`") for c in rows.columns]
    rows.select(*checked).write.insertInto(f"`{database}`.`{table}`")
