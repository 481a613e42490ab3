"""The model as tables bucketed by city, over which the reports need no exchange.

All three tables are dealt by the hash of their city into the same number of buckets.  A task then
reads the same bucket of every table: the aggregates per city and the joins on it find their rows
together.  The fact's parts are dealt before they are joined, so that fact rows go from the join
into their bucket, neither shuffled nor sorted, and are written once.  A city with many rows is joined in cells, which
several tasks write into files of its bucket; the others of a bucket are one task's.  It pays where the reports run often.  A bucket is
read by one task, so such a city is better served by the plain layout, whose partial aggregates spread it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climastar.operators.joins import CELLS_PER_TASK
from climastar.plans.model import FactSource, StarModel, fact_parts, join_parts

#: Column of each table that holds the city.
CITY_COLUMNS = {"fact_table": "city", "dimension_table_airport": "municipality", "dimension_table_demographics": "city"}
#: Fact rows of a bucket, on average.
ROWS_PER_BUCKET = 5_000_000
#: Files that a task has open at once; with rows of more buckets it sorts the rest.
OPEN_FILES = 2 * CELLS_PER_TASK
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def bucket_count(rows: int, least: int) -> int:
    """Buckets for so many fact rows, a power of two; ``least``: tasks that the cluster runs at once."""
    wanted = max(1, least, -(-rows // ROWS_PER_BUCKET))
    return 1 << (wanted - 1).bit_length()


def colocated_fact(src: FactSource, buckets: int) -> DataFrame:
    """The fact in as many tasks as buckets, whose rows are those of few buckets: its parts are shuffled and sorted, it is not."""
    return join_parts(*fact_parts(src.temperatures, src.airports, src.demographics), src.key, tasks=buckets, buckets=buckets)


def write_colocated(spark: SparkSession, model: StarModel, base: str, database: str, buckets: int) -> None:
    """Write the three tables into ``database`` under ``base``, replacing earlier ones.  Rows are dealt by the city before the
    write, so that a bucket is written by one task, or one of a city with many rows by some."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{base.rstrip('/')}/{database}.db'")
    # A task has few buckets, so few open files: Spark need not sort its rows by the bucket first.
    was = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(OPEN_FILES))
    try:
        for name, df in model.tables().items():
            city = CITY_COLUMNS[name]
            if name == "fact_table" and model.source is not None:
                df = colocated_fact(model.source, buckets)
            else:
                df = df.repartition(buckets, F.col(city))
            (df.write.mode("overwrite").format("parquet").option("compression", "zstd").bucketBy(buckets, city)
             .saveAsTable(f"`{database}`.`{name}`"))
    finally:
        spark.conf.set(_WRITERS, was)


def read_colocated(spark: SparkSession, database: str) -> StarModel:
    def table(name: str) -> DataFrame:
        return spark.table(f"`{database}`.`{name}`")

    return StarModel(*map(table, CITY_COLUMNS))
