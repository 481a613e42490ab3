"""Raw-source stand-ins derived from the driver tables.

The three public inputs of the source project (airport codes CSV, city
demographics JSON, surface temperatures CSV) are not available offline.
These functions derive relations of the same shape from the TPC-H-like
driver tables, so every downstream plan reads data that grows with the
scale factor:

* temperatures  = orders x customer x nation x region (one row per order);
* airports      = supplier x nation x region (one row per supplier);
* demographics  = customer x nation x region, aggregated per
  (nation, region, market segment), with per-nation totals.

The temperature and airport stand-ins are all text, like a CSV read without
inference; the demographics stand-in carries JSON-like numbers.  City is the
nation name and the country (airport ``iso_country``) is the region name, so
the country filter value for these tables is ``'AMERICA'``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climastar.sources.readers import source_path

STANDIN_COUNTRY = "AMERICA"

# Types of the driver-table columns the stand-ins read.
DRIVER_COLUMN_TYPES = {
    "n_nationkey": "int", "n_name": "string", "n_regionkey": "int",
    "r_regionkey": "int", "r_name": "string",
    "c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string",
    "s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double",
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
}


def _table(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    """Parquet scan of the named columns with their declared types, so no
    job is spent inferring the schema from the file footers."""
    ddl = ", ".join(f"{c} {DRIVER_COLUMN_TYPES[c]}" for c in cols)
    return spark.read.schema(ddl).parquet(source_path(sf_dir, f"{name}.parquet"))


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_nationkey, n_name, r_name): one row per nation.  Spark broadcasts
    it by its measured size."""
    n = _table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = _table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


def _money_text(c) -> F.Column:
    return c.cast(T.DecimalType(15, 2)).cast(T.StringType())


def _hemisphere_text(c, neg: str, pos: str) -> F.Column:
    return F.concat(F.abs(c).cast(T.DecimalType(9, 2)).cast(T.StringType()),
                    F.when(c < 0, F.lit(neg)).otherwise(F.lit(pos)))


def raw_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the temperature CSV: dt, AverageTemperature,
    AverageTemperatureUncertainty, City, Country, Latitude, Longitude."""
    o = _table(spark, sf_dir, "orders", ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    c = _table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    cg = c.join(geography(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))
    t = o.join(cg, o.o_custkey == cg.c_custkey)
    return t.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(_money_text(F.col("o_totalprice"))).alias("AverageTemperature"),
        _money_text(F.col("c_acctbal")).alias("AverageTemperatureUncertainty"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("Country"),
        _hemisphere_text(F.col("c_acctbal"), "S", "N").alias("Latitude"),
        _hemisphere_text(F.col("c_acctbal"), "W", "E").alias("Longitude"),
    )


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the airport-codes CSV (all text)."""
    s = _table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    sg = s.join(geography(spark, sf_dir), s.s_nationkey == F.col("n_nationkey"))
    key = F.col("s_suppkey").cast("string")
    return sg.select(
        key.alias("ident"),
        F.when(F.col("s_acctbal") < 0, F.lit("heliport")).otherwise(F.lit("small_airport")).alias("type"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").cast(T.DecimalType(9, 2)).cast("string").alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.col("r_name").alias("iso_country"),
        F.concat(F.col("r_name"), F.lit("-"), F.col("n_nationkey").cast("string")).alias("iso_region"),
        F.col("n_name").alias("municipality"),
        key.alias("gps_code"),
        F.lit(None).cast("string").alias("iata_code"),
        key.alias("local_code"),
        F.concat(key, F.lit(", "), F.col("s_nationkey").cast("string")).alias("coordinates"),
    )


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the demographics JSON: one row per (city, state, race).

    Customers are aggregated per (nation, region, segment) first; the
    per-city totals then come from a window over those few aggregated rows,
    so no city's customers are ever gathered in one task.
    """
    c = _table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    cg = c.join(geography(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))

    def n_if(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    seg = cg.groupBy("n_name", "r_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("seg_count"),
        n_if(F.col("c_acctbal") < 0).alias("seg_veterans"),
        n_if(F.col("c_custkey") % 2 == 0).alias("seg_male"),
        n_if(F.col("c_custkey") % 2 == 1).alias("seg_female"),
        n_if(F.col("c_mktsegment") == "BUILDING").alias("seg_foreign"),
        F.min("c_acctbal").alias("seg_min"),
        F.max("c_acctbal").alias("seg_max"),
    )
    w = Window.partitionBy("n_name")
    return seg.select(
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.min("seg_min").over(w).alias("median_age"),
        F.sum("seg_male").over(w).alias("male_population"),
        F.sum("seg_female").over(w).alias("female_population"),
        F.sum("seg_count").over(w).alias("total_population"),
        F.sum("seg_veterans").over(w).alias("number_of_veterans"),
        F.sum("seg_foreign").over(w).alias("foreign_born"),
        F.max("seg_max").over(w).alias("average_household_size"),
        F.substring("r_name", 1, 2).alias("state_code"),
        F.col("c_mktsegment").alias("race"),
        F.col("seg_count").alias("count"),
    )


def raw_immigration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns of the immigration table, one row per order.  ``admnum``
    lies above 2^53, where a double no longer holds every integer."""
    o = _table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    c = _table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        key.cast("string").alias("cicid"),
        F.year(day).cast("string").alias("i94yr"),
        F.month(day).cast("string").alias("i94mon"),
        F.col("c_nationkey").cast("string").alias("i94cit"),
        F.col("c_nationkey").cast("string").alias("i94res"),
        F.substring("c_mktsegment", 1, 3).alias("i94port"),
        F.date_format(day, "yyyyMMdd").alias("dtadfile"),
        F.lit("1").alias("count"),
        F.col("o_orderstatus").alias("entdepa"),
        F.when(key % 3 == 0, F.lit("M")).when(key % 3 == 1, F.lit("F")).otherwise(F.lit("unknown")).alias("gender"),
        (F.lit(9007199254740993) + key).cast("string").alias("admnum"),
        F.lit("B2").alias("visatype"),
    )


def state_temperatures(temperatures: DataFrame) -> DataFrame:
    """Columns of the state temperature table from cleaned temperatures: one
    row per year, month, city (taken as state) and country."""
    return temperatures.groupBy("year", "mon", F.col("city").alias("state"), "country").agg(
        F.round(F.avg("average_temperature"), 6).alias("average_temperature"),
        F.max("average_temperature_uncertainty").alias("average_temperature_uncertainty"))
