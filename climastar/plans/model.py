"""The star model: one fact table and two dimension tables.

The fact joins temperatures, airports and demographics on the city name and
keeps 20 business columns.  Because the three parts share only the city, a
fact row is distinct exactly when its temperature part, its airport part and
its demographics part are each distinct within the city:

    distinct(T x_city A x_city D) = distinct(T) x_city distinct(A) x_city distinct(D)

so the inputs are de-duplicated (narrow projections, small shuffles) and the
join output needs no de-duplication of its own.  The surrogate key is added
after that, so it can neither hide duplicates nor differ between reruns.

Physical plan: one ``grid_join`` of the three parts at every size.  A city
whose T·A·D rows exceed a cell is cut into a grid over all three parts, and
the cells are dealt to a number of tasks that is known before the join: the
session's shuffle partitions for a lazily built fact, the exact row count
over ``FACT_ROWS_PER_TASK`` when it is written.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climastar.functions.keys import key_of_texts, key_text, monotonic_key
from climastar.operators.aggregates import dedup
from climastar.operators.joins import Side, grid_join, key_counts
from climastar.sources.readers import source_path
from climastar.sources.sinks import clustered, write_parquet_overwrite

# Fact columns by origin, in output order.
FACT_TEMPERATURE_COLUMNS = ["average_temperature", "average_temperature_uncertainty",
                            "city", "country", "year", "mon"]
FACT_AIRPORT_COLUMNS = ["ident", "type", "elevation_ft", "continent", "iso_country",
                        "iso_region", "gps_code", "iata_code", "local_code"]
FACT_DEMOGRAPHICS_COLUMNS = ["ave_household_size", "count", "state", "state_code",
                             "total_population"]
FACT_COLUMNS = FACT_TEMPERATURE_COLUMNS + FACT_AIRPORT_COLUMNS + FACT_DEMOGRAPHICS_COLUMNS
DIM_AIRPORT_COLUMNS = ["municipality", "elevation_ft", "airport_name", "iso_country",
                       "iso_region", "latitude", "longitude"]
DIM_DEMOGRAPHICS_COLUMNS = ["city", "state", "median_age", "male_population",
                            "female_population", "total_population", "veteran_population",
                            "foreign_born", "ave_household_size", "state_code", "race", "count"]

TABLE_NAMES = ("fact_table", "dimension_table_airport", "dimension_table_demographics")

# Rows per written Parquet file (about 100-200 MB of fact rows).
FACT_RECORDS_PER_FILE = 2_000_000


@dataclass
class StarModel:
    fact: DataFrame
    dim_airport: DataFrame
    dim_demographics: DataFrame
    # Distinct temperature rows (fact columns), set when the model is built
    # in the same plan: per-city means can then be taken before the fan-out.
    # Cities without airports or demographics are still in it; reports drop
    # them by their inner joins with the per-city dimension aggregates.
    temperature_part: DataFrame | None = None
    # The cleaned inputs, kept so that ``write_model`` can size the join from
    # the exact fact row count (see ``write_fact``).
    source: "FactSource | None" = None

    def tables(self) -> dict[str, DataFrame]:
        return dict(zip(TABLE_NAMES, (self.fact, self.dim_airport, self.dim_demographics)))


@dataclass
class FactSource:
    temperatures: DataFrame
    airports: DataFrame
    demographics: DataFrame
    key: str


def fact_parts(temperatures: DataFrame, airports: DataFrame, demographics: DataFrame):
    """Distinct projections of the three inputs onto their fact columns."""
    t = dedup(temperatures, FACT_TEMPERATURE_COLUMNS)
    a = dedup(airports, ["municipality"] + FACT_AIRPORT_COLUMNS)
    d = dedup(demographics, ["city"] + FACT_DEMOGRAPHICS_COLUMNS).withColumnRenamed("city", "__d_city")
    return t, a, d


def _parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (at least this many tasks write the fact)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:      # no driver context (remote session)
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Columns that carry the key texts of the three parts through the join.
_KEY_TEXTS = ("__t_text", "__a_text", "__d_text")


def join_parts(t: DataFrame, a: DataFrame, d: DataFrame, key: str, tasks: int | None = None, broadcast: bool = False,
               buckets: int | None = None) -> DataFrame:
    """The fact from its three distinct parts; ``broadcast``: ``a`` and ``d`` are, and rows stay in the tasks and order of ``t``.
    ``buckets``: cells are dealt by the buckets of their cities (see ``grid_join``)."""
    t, a, d = _with_key_texts(t, a, d, key)
    if broadcast:
        return _fact_of(_by_city(t, F.broadcast(a), F.broadcast(d)), key)
    sides = [Side(t, "city", True), Side(a, "municipality", True), Side(d, "__d_city", True)]
    return _fact_of(grid_join(sides, tasks=tasks, buckets=buckets), key)


def _with_key_texts(t: DataFrame, a: DataFrame, d: DataFrame, key: str) -> tuple[DataFrame, ...]:
    """A part's share of the key's text is built before the join, once a row; after it, where a row is repeated for every
    combination, the three are only put together and hashed."""
    if key == "monotonic":
        return t, a, d
    return tuple(part.withColumn(name, key_text(part, columns)) for part, name, columns in zip(
        (t, a, d), _KEY_TEXTS, (FACT_TEMPERATURE_COLUMNS, FACT_AIRPORT_COLUMNS, FACT_DEMOGRAPHICS_COLUMNS)))


def _by_city(t: DataFrame, a: DataFrame, d: DataFrame) -> DataFrame:
    return t.join(a, F.col("city") == F.col("municipality")).join(d, F.col("city") == F.col("__d_city"))


def _fact_of(tad: DataFrame, key: str) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in FACT_COLUMNS]
    return tad.select(*columns, (monotonic_key() if key == "monotonic" else key_of_texts(*map(F.col, _KEY_TEXTS))).alias("id"))


def build_fact(temperatures: DataFrame, airports: DataFrame, demographics: DataFrame,
               key: str = "stable") -> DataFrame:
    """Fact table: 20 business columns + ``id``.  Nothing runs here.

    ``key="stable"`` gives the first 128 bits of a SHA-256 of the business
    columns (same value on every run and engine); ``key="monotonic"`` gives
    ``monotonically_increasing_id`` as the source job did.
    """
    return join_parts(*fact_parts(temperatures, airports, demographics), key)


# Airports and demographics rows up to which ``clustered_fact`` broadcasts them.
BROADCAST_ROWS = 500_000


def clustered_fact(src: FactSource, keys: Sequence[str], files: int) -> DataFrame:
    """The fact ranged over ``files`` tasks by ``keys`` (temperature columns) and sorted by them.  Temperatures are ranged before the
    fan-out, which keeps their tasks and order, so that no fact row is shuffled or sorted.  Airports or demographics too many to be
    broadcast are joined by the grid, and the fact is ranged."""
    t, a, d = fact_parts(src.temperatures, src.airports, src.demographics)
    if max(a.count(), d.count()) > BROADCAST_ROWS:
        return clustered(join_parts(t, a, d, src.key), keys, files)
    return join_parts(clustered(t, keys, files), a, d, src.key, broadcast=True)


# Target fact rows per task when the fact is written.
FACT_ROWS_PER_TASK = 5_000_000


def fact_row_count(t: DataFrame, a: DataFrame, d: DataFrame) -> DataFrame:
    """(city, fact_rows): |T|·|A|·|D| per city, from three small counts."""
    tc, ac, dc = key_counts(t, "city", "t", "city"), key_counts(a, "municipality", "a", "ka"), key_counts(d, "__d_city", "d", "kd")
    j = tc.join(ac, F.col("city") == F.col("ka")).join(dc, F.col("city") == F.col("kd"))
    return j.select("city", (F.col("t") * F.col("a") * F.col("d")).alias("fact_rows"))


def write_fact(src: FactSource, path: str) -> int:
    """Write the fact by a number of tasks that its exact row count gives.

    1. The distinct temperature rows are written beside ``path``, so that
       their scan and de-duplication run once and a failed fact task
       restarts from written rows.
    2. Per-city counts of the three parts give the exact number of fact rows
       (one row on the driver), and ceil(rows / ``FACT_ROWS_PER_TASK``) tasks.
    3. The fact is joined from the written rows and written.

    The staged rows are emptied afterwards, also when the write fails.
    """
    t, a, d = fact_parts(src.temperatures, src.airports, src.demographics)
    spark = src.temperatures.sparkSession
    stage = f"{path.rstrip('/')}.parts"
    schema = T.StructType(table_schema("fact_table").fields[:len(FACT_TEMPERATURE_COLUMNS)])
    try:
        t.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("overwrite").parquet(stage)
        staged = spark.read.schema(schema).parquet(stage)
        total = fact_row_count(staged, a, d).agg(F.coalesce(F.sum("fact_rows"), F.lit(0)).cast("long")).first()[0]
        tasks = max(_parallelism(spark), -(-total // FACT_ROWS_PER_TASK))
        return write_parquet_overwrite(join_parts(staged, a, d, src.key, tasks), path, "fact_table",
                                       max_records_per_file=FACT_RECORDS_PER_FILE)
    finally:
        _empty(spark, stage, schema)


def _empty(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Free a staging folder: overwrite it with no rows.  A failure is
    logged; it does not hide an error of the write itself."""
    try:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    except Exception:
        logging.getLogger(__name__).exception("staging folder %s could not be emptied", path)


def build_dim_airport(airports: DataFrame) -> DataFrame:
    return dedup(airports, DIM_AIRPORT_COLUMNS)


def build_dim_demographics(demographics: DataFrame) -> DataFrame:
    return dedup(demographics, DIM_DEMOGRAPHICS_COLUMNS)


def build_model(temperatures: DataFrame, airports: DataFrame, demographics: DataFrame,
                key: str = "stable") -> StarModel:
    return StarModel(build_fact(temperatures, airports, demographics, key),
                     build_dim_airport(airports), build_dim_demographics(demographics),
                     temperature_part=dedup(temperatures, FACT_TEMPERATURE_COLUMNS),
                     source=FactSource(temperatures, airports, demographics, key))


def model_from_clean(c, key: str = "stable") -> StarModel:
    """Model from ``plans.clean.CleanInputs``."""
    return build_model(c.temperatures, c.airports, c.demographics, key=key)


def write_model(model: StarModel, base: str) -> dict[str, int]:
    """Write the three tables under ``base`` (overwrite) and return the row
    count of each write, taken during the write.

    The writes are independent actions, submitted together from driver
    threads so that the small dimension jobs use slots the fact job leaves
    free instead of waiting behind it.
    """
    from concurrent.futures import ThreadPoolExecutor

    def write(item):
        name, df = item
        path = source_path(base, name)
        if name == "fact_table" and model.source is not None:
            return name, write_fact(model.source, path)
        return name, write_parquet_overwrite(df, path, name,
                                             max_records_per_file=FACT_RECORDS_PER_FILE)

    with ThreadPoolExecutor(max_workers=len(TABLE_NAMES)) as pool:
        return dict(pool.map(write, model.tables().items()))


_TYPES = {
    "average_temperature": "double", "average_temperature_uncertainty": "double",
    "city": "string", "country": "string", "year": "int", "mon": "int", "ident": "string",
    "type": "string", "elevation_ft": "int", "continent": "string", "iso_country": "string",
    "iso_region": "string", "gps_code": "string", "iata_code": "string", "local_code": "string",
    "ave_household_size": "double", "count": "int", "state": "string", "state_code": "string",
    "total_population": "int", "id": "string", "municipality": "string",
    "airport_name": "string", "latitude": "double", "longitude": "double",
    "median_age": "double", "male_population": "int", "female_population": "int",
    "veteran_population": "int", "foreign_born": "int", "race": "string",
}


def table_schema(name: str, key: str = "stable") -> T.StructType:
    """Published schema of a model table; the fact's ``id`` is a string for
    the stable key and a bigint for the monotonic one."""
    cols = {"fact_table": FACT_COLUMNS + ["id"],
            "dimension_table_airport": DIM_AIRPORT_COLUMNS,
            "dimension_table_demographics": DIM_DEMOGRAPHICS_COLUMNS}[name]
    types = dict(_TYPES, id="bigint" if key == "monotonic" else "string")
    return T.StructType.fromDDL(", ".join(f"`{c}` {types[c]}" for c in cols))


def read_model(spark: SparkSession, base: str, key: str = "stable") -> StarModel:
    """The written tables, read with their declared schemas (no footer scan
    to infer them)."""
    fact, air, demo = (spark.read.schema(table_schema(n, key)).parquet(source_path(base, n))
                       for n in TABLE_NAMES)
    return StarModel(fact, air, demo)
