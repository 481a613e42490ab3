"""Registered queries: one callable (spark, sf_dir) -> DataFrame per
inventory item.  All of them read the driver tables through the stand-ins
of ``climastar.sources.standins``; none runs on fixed inline data.
Queries that exercise a sink write under a fresh folder of the shared root
(``spark.checkpoint.dir``) and return the read-back result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climastar.functions import (
    date_month, date_year, hemisphere_coordinate, split_part, stable_key, to_decimal,
    to_double, to_float, to_int, to_long,
)
from climastar.functions.parsing import hemisphere_coordinate_udf
from climastar.operators.aggregates import dedup, row_counts
from climastar.operators.filters import drop_missing, equals
from climastar.operators.joins import fanout_join
from climastar.operators.projection import drop, rename
from climastar.operators.quality import (
    audit_files, constraint_violations, content_match, duplicate_summary, file_manifest, long_key_summary, non_empty_flags,
    qa_report, readable, row_count_match,
)
from climastar.plans import reports as R
from climastar.plans.clean import (
    TEMPERATURE_RENAMES, CleanInputs, clean_airports, clean_all, clean_demographics,
    clean_temperatures, gate,
)
from climastar.plans.colocated import bucket_count, read_colocated, write_colocated
from climastar.plans.incremental import read_fact, rebuild_fact
from climastar.plans.model import (
    DIM_AIRPORT_COLUMNS, DIM_DEMOGRAPHICS_COLUMNS, FACT_COLUMNS, FACT_TEMPERATURE_COLUMNS,
    FactSource, StarModel, build_dim_airport, build_dim_demographics, build_fact, clustered_fact, model_from_clean,
    read_model, table_schema, write_model,
)
from climastar.plans.pipeline import RawInputs, run_pipeline
from climastar.session import new_run_dir
from climastar.sources import contracts
from climastar.sources.publish import publish, read_published
from climastar.sources.quarantine import quarantine_load
from climastar.sources.readers import (
    read_csv_checked, read_csv_strings, read_demographics_checked, read_demographics_json, read_parquet, source_path,
)
from climastar.sources.sinks import write_parquet_overwrite, write_parquet_receipt
from climastar.sources.standins import (
    STANDIN_COUNTRY, raw_airports, raw_demographics, raw_immigration, raw_temperatures,
    state_temperatures,
)

Query = Callable[[SparkSession, str], DataFrame]

# Preferred climate for the veteran ranking on the stand-in data, whose
# "temperatures" are order prices.
VETERAN_MIN_TEMPERATURE = 245000.0
VETERAN_MAX_TEMPERATURE = 270000.0


def raw_inputs(spark: SparkSession, sf: str) -> RawInputs:
    return RawInputs(raw_temperatures(spark, sf), raw_airports(spark, sf), raw_demographics(spark, sf))


def clean_inputs(spark: SparkSession, sf: str, check: bool = True) -> CleanInputs:
    raw = raw_inputs(spark, sf)
    return clean_all(raw.temperatures, raw.airports, raw.demographics,
                     STANDIN_COUNTRY, STANDIN_COUNTRY, check)


def cleaned(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One cleaned and gated input; the others are not touched."""
    if name == "temperatures":
        df = clean_temperatures(raw_temperatures(spark, sf), STANDIN_COUNTRY, check=False)
    elif name == "airports":
        df = clean_airports(raw_airports(spark, sf), STANDIN_COUNTRY, check=False)
    else:
        df = clean_demographics(raw_demographics(spark, sf), check=False)
    gate({name: df})
    return df


def model(spark: SparkSession, sf: str) -> StarModel:
    return model_from_clean(clean_inputs(spark, sf))


# ---- sources and sinks ---------------------------------------------------

def q_scan_csv_strings(spark, sf):
    path = new_run_dir(spark, "csv") + "/airports"
    raw_airports(spark, sf).write.option("header", True).csv(path)
    return read_csv_strings(spark, path)


def q_scan_json(spark, sf):
    """Records of two segments have the title-case names, the others the
    snake-case ones, in one folder."""
    path = new_run_dir(spark, "json") + "/demographics"
    raw = raw_demographics(spark, sf)
    title = F.col("race").isin("BUILDING", "MACHINERY")
    names = {"city": "City", "state": "State", "median_age": "Median Age", "male_population": "Male Population",
             "female_population": "Female Population", "total_population": "Total Population",
             "number_of_veterans": "Number of Veterans", "foreign_born": "Foreign-born",
             "average_household_size": "Average Household Size", "state_code": "State Code", "race": "Race", "count": "Count"}
    raw.where(~title).write.json(path)
    raw.where(title).select(*[F.col(a).alias(b) for a, b in names.items()]).write.mode("append").json(path)
    return clean_demographics(read_demographics_json(spark, path))


def q_scan_parquet(spark, sf):
    return read_parquet(spark, source_path(sf, "orders.parquet"))


def q_sink_parquet_overwrite(spark, sf):
    a = cleaned(spark, sf, "airports")
    path = new_run_dir(spark, "sink") + "/airports"
    write_parquet_overwrite(a, path)
    write_parquet_overwrite(a, path)   # rerun: overwrite, not append
    return read_parquet(spark, path)


AIRPORT_COLUMNS = ["ident", "type", "name", "elevation_ft", "continent", "iso_country", "iso_region", "municipality", "gps_code", "iata_code",
                   "local_code", "coordinates"]


def q_scan_csv_malformed(spark, sf):
    """Airports in a CSV whose lines of heliports end after three fields: (ident, malformed), the id of a good record or the text of
    a damaged one."""
    path = new_run_dir(spark, "csv-damaged") + "/airports"
    raw = raw_airports(spark, sf)
    cut = F.col("type") == "heliport"
    line = F.to_csv(F.struct(*AIRPORT_COLUMNS))
    text = F.when(cut, F.concat_ws(",", "ident", "type", "name")).otherwise(line)
    # The header of every file is its first line.
    header = F.lit(",".join(AIRPORT_COLUMNS))
    files = raw.select(F.spark_partition_id().alias("p"), text.alias("value"))
    heads = files.select("p").distinct().select("p", header.alias("value"), F.lit(0).alias("o"))
    tagged = heads.unionByName(files.withColumn("o", F.lit(1))).repartition(4, "p").sortWithinPartitions("p", "o")
    tagged.select("p", "value").write.partitionBy("p").text(path)
    checked = read_csv_checked(spark, path, AIRPORT_COLUMNS)
    return checked.rows.select(F.when(F.col("malformed").isNull(), F.col("ident")).alias("ident"), "malformed")


def q_scan_json_malformed(spark, sf):
    """Demographics in JSON lines, those of one segment without their closing brace: (city, race, malformed)."""
    path = new_run_dir(spark, "json-damaged") + "/demographics"
    raw = raw_demographics(spark, sf)
    text = F.to_json(F.struct("city", "race", "state_code"))
    damaged = F.when(F.col("race") == "BUILDING", F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    raw.select("race", text.alias("value")).select(damaged.alias("value")).write.text(path)
    return read_demographics_checked(spark, path).rows.select("city", "race", "malformed")


def q_publish_versions(spark, sf):
    """Two versions of the airports, published one after the other: (version, municipality, ident) of both as they are read back."""
    base = new_run_dir(spark, "published")
    air = cleaned(spark, sf, "airports")
    for rows in (air.where("type = 'heliport'"), air):
        publish(spark, base, lambda path, rows=rows: {"airports": write_parquet_overwrite(rows, source_path(path, "airports"))})
    schema = air.schema
    return _union([read_published(spark, base, "airports", version, schema).select(F.lit(shown).alias("version"), "municipality", "ident")
                   for version, shown in ((1, 1), (None, 2))])


#: Day of the stand-in's last but one delivery.
DELIVERY = (2001, 7)


def q_incremental_rebuild(spark, sf):
    """The fact built from a delivery that ends before ``DELIVERY``, then brought up to date with all temperatures:
    (year, fact_rows, rewritten) of the stored fact."""
    c = clean_inputs(spark, sf)
    base = new_run_dir(spark, "incremental")
    year, mon = DELIVERY
    before = c.temperatures.where((F.col("year") < year) | ((F.col("year") == year) & (F.col("mon") < mon)))
    rebuild_fact(FactSource(before, c.airports, c.demographics, "stable"), base)
    done = rebuild_fact(FactSource(c.temperatures, c.airports, c.demographics, "stable"), base)
    return read_fact(spark, base).groupBy("year").agg(F.count(F.lit(1)).alias("fact_rows")).withColumn("rewritten", F.col("year").isin(done.rewritten))


#: City and year that are read from the clustered fact.
CLUSTERED_CITY, CLUSTERED_YEAR, CLUSTERED_FILES = "NATION_6", 1997, 16


def q_fact_clustered_city(spark, sf):
    """One city's year from the fact written in ranges of city and year, whose other files are skipped by their statistics."""
    path = new_run_dir(spark, "clustered")
    write_parquet_overwrite(clustered_fact(model(spark, sf).source, ["city", "year"], CLUSTERED_FILES), path)
    stored = spark.read.schema(table_schema("fact_table")).parquet(path)
    return stored.where((F.col("city") == CLUSTERED_CITY) & (F.col("year") == CLUSTERED_YEAR))


def q_preview_top20(spark, sf):
    return R.preview(R.report_city_climate(model(spark, sf)), 20)


def q_table_reset(spark, sf):
    t = cleaned(spark, sf, "temperatures")
    base, db = _own_database(spark)
    for _ in range(2):
        contracts.reset_tables(spark, ["city_surface_temps"], base, db)
        contracts.load_table(t, "city_surface_temps", db)
    return spark.table(f"{db}.city_surface_temps")


def _own_database(spark) -> tuple[str, str]:
    """A folder and a database name that no other run uses."""
    base = new_run_dir(spark, "tables")
    return base, "climastar_" + base.rsplit("-", 1)[1]


def loadable_airports(airports: DataFrame) -> DataFrame:
    """Airports with codes as short as the declared table has them (the
    stand-in's are longer)."""
    code = F.expr("right(ident, 4)")
    return airports.withColumns({
        "ident": F.expr("right(ident, 5)"), "gps_code": code, "local_code": code,
        "iso_country": F.substring("iso_country", 1, 2),
        "iso_region": F.concat(F.substring("iso_region", 1, 2), F.lit("-"), F.expr("right(iso_region, 2)"))})


def contract_inputs(spark, sf) -> dict[str, DataFrame]:
    """A source for each of the five declared tables."""
    t = cleaned(spark, sf, "temperatures")
    return {"cities_demog": cleaned(spark, sf, "demographics"), "airport_codes": cleaned(spark, sf, "airports"),
            "immigration": raw_immigration(spark, sf), "city_surface_temps": t, "state_surface_temps": state_temperatures(t)}


def loadable_immigration(immigration: DataFrame) -> DataFrame:
    """Immigration with a gender of one letter, as declared: ``U`` for anything but M and F."""
    gender = F.when(F.col("gender").isin("M", "F"), F.col("gender")).when(F.col("gender").isNotNull(), "U")
    return immigration.withColumn("gender", gender)


def q_table_reset_all(spark, sf):
    """Reset and load all rows of all five declared tables twice, rows that break a rule into quarantine: (table, rows, rejected)."""
    loads = contract_inputs(spark, sf)
    loads["airport_codes"] = loadable_airports(loads["airport_codes"])
    loads["immigration"] = loadable_immigration(loads["immigration"])
    base, db = _own_database(spark)
    names = list(contracts.CONTRACTS)
    for _ in range(2):
        contracts.reset_tables(spark, names, base, db)
        done = {name: quarantine_load(spark, df, name, db) for name, df in loads.items()}
    parts = [spark.table(f"{db}.{n}").agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(n).alias("table"), "rows", F.lit(done[n].rejected).cast("long").alias("rejected")) for n in names]
    return _union(parts)


def q_quarantine_load(spark, sf):
    """Airports and immigration as they come, both with values longer than declared: (table, violations, rows) of the accepted rows
    (no violations) and of the rejected ones by the rules they break."""
    loads = {name: df for name, df in contract_inputs(spark, sf).items() if name in ("airport_codes", "immigration")}
    base, db = _own_database(spark)
    contracts.reset_tables(spark, list(loads), base, db)
    parts = []
    for name, df in loads.items():
        quarantine_load(spark, df, name, db)
        accepted = spark.table(f"{db}.{name}").select(F.lit("").alias("violations"))
        rejected = spark.table(f"{db}.{name}_rejected").select(F.array_join("violations", "; ").alias("violations"))
        parts.append(accepted.union(rejected).groupBy("violations").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "violations", "rows"))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_schema_conform(spark, sf):
    return contracts.conform(cleaned(spark, sf, "airports"), "airport_codes")


def q_schema_conform_demographics(spark, sf):
    return contracts.conform(cleaned(spark, sf, "demographics"), "cities_demog")


def q_schema_conform_temperatures(spark, sf):
    return contracts.conform(cleaned(spark, sf, "temperatures"), "city_surface_temps")


def q_schema_conform_immigration(spark, sf):
    return contracts.conform(raw_immigration(spark, sf), "immigration")


def q_schema_conform_state_temperatures(spark, sf):
    return contracts.conform(state_temperatures(cleaned(spark, sf, "temperatures")), "state_surface_temps")


def q_constraint_violations(spark, sf):
    parts = [constraint_violations(df, name) for name, df in contract_inputs(spark, sf).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- projections, casts, parsing ------------------------------------------

def q_project_rename(spark, sf):
    return rename(raw_temperatures(spark, sf), TEMPERATURE_RENAMES)


def q_cast_tolerant(spark, sf):
    """Also text of integers above 2^53, made from each row's price, and text
    that ends like a Java number, which is none."""
    raw = raw_temperatures(spark, sf)
    whole = F.concat(F.lit("90071992547"), F.lpad(F.regexp_extract("AverageTemperature", r"^\d+", 0), 8, "0"))
    return raw.select(
        "dt", "AverageTemperature", "AverageTemperatureUncertainty",
        to_long(whole).alias("large_long"),
        to_int(F.concat(F.col("AverageTemperature"), F.lit("d"))).alias("suffixed_int"),
        to_int("dt").alias("dt_int"),
        to_int("AverageTemperature").alias("temperature_int"),
        to_long("AverageTemperature").alias("temperature_long"),
        to_float("AverageTemperature").alias("temperature_float"),
        to_double("AverageTemperature").alias("temperature_double"),
        to_decimal("AverageTemperatureUncertainty", 9, 2).alias("uncertainty_decimal"),
        to_decimal("AverageTemperature", 5, 2).alias("temperature_decimal_overflow"),
    )


def q_project_drop(spark, sf):
    raw = raw_airports(spark, sf)
    with_coords = raw.withColumns({
        "latitude": to_double(split_part("coordinates", ", ", 1)),
        "longitude": to_double(split_part("coordinates", ", ", 0))})
    return drop(with_coords, "coordinates")


def q_split_lon_lat(spark, sf):
    return raw_airports(spark, sf).select(
        "ident", "coordinates",
        to_double(split_part("coordinates", ", ", 1)).alias("latitude"),
        to_double(split_part("coordinates", ", ", 0)).alias("longitude"),
        split_part("coordinates", ", ", 2).alias("third_item"))


def q_date_year_month(spark, sf):
    return raw_temperatures(spark, sf).select(
        "dt", date_year("dt").alias("year"), date_month("dt").alias("mon"))


def q_hemisphere_coordinate(spark, sf):
    return raw_temperatures(spark, sf).select(
        F.col("Latitude").alias("latitude_text"), F.col("Longitude").alias("longitude_text"),
        hemisphere_coordinate("Latitude").alias("latitude"),
        hemisphere_coordinate("Longitude").alias("longitude"))


def q_hemisphere_coordinate_udf(spark, sf):
    return raw_temperatures(spark, sf).select(
        F.col("Latitude").alias("latitude_text"), F.col("Longitude").alias("longitude_text"),
        hemisphere_coordinate_udf("Latitude").alias("latitude"),
        hemisphere_coordinate_udf("Longitude").alias("longitude"))


def q_surrogate_key_stable(spark, sf):
    t = cleaned(spark, sf, "temperatures")
    return t.withColumn("id", stable_key(t, t.columns))


def q_surrogate_key_monotonic(spark, sf):
    """(rows, distinct_ids, passed): the ids depend on the partitioning, but
    every row of the fact must have one of its own."""
    c = clean_inputs(spark, sf)
    fact = build_fact(c.temperatures, c.airports, c.demographics, key="monotonic")
    return long_key_summary(fact, "id").withColumn("passed", F.col("rows") == F.col("distinct_ids"))


# ---- filters ----------------------------------------------------------------

def q_filter_country_code(spark, sf):
    return equals(raw_airports(spark, sf), "iso_country", STANDIN_COUNTRY)


def q_filter_country_name(spark, sf):
    return equals(raw_temperatures(spark, sf), "Country", STANDIN_COUNTRY)


def q_filter_drop_null_measure(spark, sf):
    raw = raw_temperatures(spark, sf)
    typed = raw.select("dt", "City", "Country",
                       to_double("AverageTemperature").alias("average_temperature"))
    return drop_missing(typed, ["average_temperature"])


# ---- joins, aggregates ------------------------------------------------------

def q_join_city_municipality(spark, sf):
    c = CleanInputs(cleaned(spark, sf, "temperatures"), cleaned(spark, sf, "airports"), None)
    air = c.airports.select("municipality", "ident", "airport_name", "elevation_ft")
    return fanout_join(c.temperatures, air, "city", "municipality")


def q_join_star_report(spark, sf):
    return R.star_join_counts(model(spark, sf))


def q_agg_count(spark, sf):
    """Rows of the inputs and of the model's tables; those of the fact, a join by
    city, are the products of its parts' counts by city."""
    c = clean_inputs(spark, sf)
    m = model_from_clean(c)
    tables = {"temperatures": c.temperatures, "airports": c.airports, "demographics": c.demographics}
    tables.update(m.tables())
    return row_counts(tables, {"fact_table": R.city_fact_rows(m).withColumnRenamed("fact_rows", "rows")})


def q_agg_group_city(spark, sf):
    """Of the fact, by city.  A city's fact rows repeat each temperature row
    equally often, so mean and extremes come from the distinct temperature
    rows and the count is the product of the parts' counts."""
    m = model(spark, sf)
    rows = R.city_fact_rows(m).withColumnRenamed("city", "fact_city")
    per_city = m.temperature_part.groupBy("city").agg(
        F.round(F.avg("average_temperature"), R.MEAN_DIGITS).alias("average_temperature"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"))
    return per_city.join(rows, per_city.city == rows.fact_city).select(
        "city", "fact_rows", "average_temperature", "first_year", "last_year")


def q_agg_first_deterministic(spark, sf):
    return R.city_attribute(StarModel(None, None, build_dim_demographics(cleaned(spark, sf, "demographics"))), "total_population")


def q_agg_count_distinct(spark, sf):
    return R.city_airport_counts(StarModel(None, build_dim_airport(cleaned(spark, sf, "airports")), None))


def q_dedup_full_row(spark, sf):
    return dedup(cleaned(spark, sf, "temperatures"), FACT_TEMPERATURE_COLUMNS)


# ---- data quality -------------------------------------------------------------

_DEDUP_COLUMNS = {"fact_table": FACT_COLUMNS,
                  "dimension_table_airport": DIM_AIRPORT_COLUMNS,
                  "dimension_table_demographics": DIM_DEMOGRAPHICS_COLUMNS}


def q_dq_non_empty(spark, sf):
    c = clean_inputs(spark, sf, check=False)
    return non_empty_flags({"temperatures": c.temperatures, "airports": c.airports, "demographics": c.demographics})


def _written_model(spark, sf):
    m = model(spark, sf)
    out = new_run_dir(spark, "model")
    counts = write_model(m, out)
    return out, counts, read_model(spark, out)


def q_dq_readable(spark, sf):
    out, _, stored = _written_model(spark, sf)
    return readable(spark, {n: source_path(out, n) for n in stored.tables()}, {n: table_schema(n) for n in stored.tables()})


def q_dq_row_count_match(spark, sf):
    _, counts, stored = _written_model(spark, sf)
    parts = [row_count_match(name, counts[name], df) for name, df in stored.tables().items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_dq_content_match(spark, sf):
    """Content of the three tables as read back against the digest observed while each was written: (table, rows_written, rows_read, passed)."""
    out = new_run_dir(spark, "content")
    parts = []
    for name, df in model(spark, sf).tables().items():
        path = source_path(out, name)
        receipt = write_parquet_receipt(df, path, name)
        parts.append(content_match(name, receipt, spark.read.schema(df.schema).parquet(path)))
    return _union(parts)


def q_dq_file_audit(spark, sf):
    """Files of the three written tables against the manifest taken after the write: (table, status, rows)."""
    out, _, stored = _written_model(spark, sf)
    parts = []
    for name in stored.tables():
        path, schema = source_path(out, name), table_schema(name)
        kept = new_run_dir(spark, "manifest")
        write_parquet_overwrite(file_manifest(spark, path, schema), kept)
        manifest = spark.read.schema("file string, bytes long, rows long, digest string").parquet(kept)
        parts.append(audit_files(manifest, file_manifest(spark, path, schema)).groupBy("status").agg(F.sum("rows").alias("rows"))
                     .select(F.lit(name).alias("table"), "status", "rows"))
    return _union(parts)


def q_dq_duplicates(spark, sf):
    """Of the written tables, on their business columns.  The fact's key is a
    hash of exactly those, so it stands for them."""
    _, _, stored = _written_model(spark, sf)
    columns = {**_DEDUP_COLUMNS, "fact_table": ["id"]}
    parts = [duplicate_summary(df, name, columns[name]) for name, df in stored.tables().items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_dq_report(spark, sf):
    _, counts, stored = _written_model(spark, sf)
    return qa_report(counts, stored.tables(), _DEDUP_COLUMNS)


# ---- composed datasets ----------------------------------------------------------

def q_clean_temperatures(spark, sf):
    return cleaned(spark, sf, "temperatures")


def q_clean_airports(spark, sf):
    return cleaned(spark, sf, "airports")


def q_clean_demographics(spark, sf):
    return cleaned(spark, sf, "demographics")


def q_fact_city_airport(spark, sf):
    return model(spark, sf).fact


def q_dim_airport(spark, sf):
    return build_dim_airport(cleaned(spark, sf, "airports"))


def q_dim_demographics(spark, sf):
    return build_dim_demographics(cleaned(spark, sf, "demographics"))


def q_report_city_climate(spark, sf):
    return R.report_city_climate(model(spark, sf))


def q_report_city_climate_colocated(spark, sf):
    """Report 1 over the tables bucketed by city."""
    m = model(spark, sf)
    base, db = _own_database(spark)
    rows = R.city_fact_rows(m).agg(F.coalesce(F.sum("fact_rows"), F.lit(0))).first()[0]
    buckets = bucket_count(rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write_colocated(spark, m, base, db, buckets)
    return R.report_city_climate(read_colocated(spark, db))


def q_report_city_veterans(spark, sf):
    return R.report_city_veterans(model(spark, sf))


def q_pipeline_end_to_end(spark, sf):
    res = run_pipeline(spark, raw_inputs(spark, sf), new_run_dir(spark, "pipeline"),
                       country_code=STANDIN_COUNTRY, country_name=STANDIN_COUNTRY)
    return res.qa


# ---- extensions promised by the documents -----------------------------------------

def q_influence_correlation(spark, sf):
    return R.influence_correlation(model(spark, sf))


def q_influence_certainty(spark, sf):
    return R.influence_certainty(model(spark, sf))


def q_rank_veteran_cities(spark, sf):
    return R.rank_veteran_cities(model(spark, sf), VETERAN_MIN_TEMPERATURE,
                                 VETERAN_MAX_TEMPERATURE, top=10)


def q_adjust_elevation(spark, sf):
    return R.adjust_elevation(model(spark, sf))


def q_adjust_latitude(spark, sf):
    return R.adjust_latitude(model(spark, sf))


def q_adjust_joint(spark, sf):
    return R.adjust_joint(model(spark, sf))


def q_report_city_female(spark, sf):
    return R.report_city_female(model(spark, sf))


QUERIES: dict[str, Query] = {
    "scan_csv_strings": q_scan_csv_strings,
    "scan_json": q_scan_json,
    "scan_csv_malformed": q_scan_csv_malformed,
    "scan_json_malformed": q_scan_json_malformed,
    "scan_parquet": q_scan_parquet,
    "sink_parquet_overwrite": q_sink_parquet_overwrite,
    "publish_versions": q_publish_versions,
    "incremental_rebuild": q_incremental_rebuild,
    "preview_top20": q_preview_top20,
    "table_reset": q_table_reset,
    "table_reset_all": q_table_reset_all,
    "quarantine_load": q_quarantine_load,
    "schema_conform": q_schema_conform,
    "schema_conform_demographics": q_schema_conform_demographics,
    "schema_conform_temperatures": q_schema_conform_temperatures,
    "schema_conform_immigration": q_schema_conform_immigration,
    "schema_conform_state_temperatures": q_schema_conform_state_temperatures,
    "constraint_violations": q_constraint_violations,
    "project_rename": q_project_rename,
    "cast_tolerant": q_cast_tolerant,
    "project_drop": q_project_drop,
    "surrogate_key_stable": q_surrogate_key_stable,
    "surrogate_key_monotonic": q_surrogate_key_monotonic,
    "filter_country_code": q_filter_country_code,
    "filter_country_name": q_filter_country_name,
    "filter_drop_null_measure": q_filter_drop_null_measure,
    "join_city_municipality": q_join_city_municipality,
    "join_star_report": q_join_star_report,
    "agg_count": q_agg_count,
    "agg_group_city": q_agg_group_city,
    "agg_first_deterministic": q_agg_first_deterministic,
    "agg_count_distinct": q_agg_count_distinct,
    "dedup_full_row": q_dedup_full_row,
    "split_lon_lat": q_split_lon_lat,
    "date_year_month": q_date_year_month,
    "hemisphere_coordinate": q_hemisphere_coordinate,
    "hemisphere_coordinate_udf": q_hemisphere_coordinate_udf,
    "dq_non_empty": q_dq_non_empty,
    "dq_readable": q_dq_readable,
    "dq_file_audit": q_dq_file_audit,
    "dq_row_count_match": q_dq_row_count_match,
    "dq_content_match": q_dq_content_match,
    "dq_duplicates": q_dq_duplicates,
    "dq_report": q_dq_report,
    "clean_demographics": q_clean_demographics,
    "clean_airports": q_clean_airports,
    "clean_temperatures": q_clean_temperatures,
    "fact_city_airport": q_fact_city_airport,
    "fact_clustered_city": q_fact_clustered_city,
    "dim_airport": q_dim_airport,
    "dim_demographics": q_dim_demographics,
    "report_city_climate": q_report_city_climate,
    "report_city_climate_colocated": q_report_city_climate_colocated,
    "report_city_veterans": q_report_city_veterans,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "influence_correlation": q_influence_correlation,
    "influence_certainty": q_influence_certainty,
    "rank_veteran_cities": q_rank_veteran_cities,
    "adjust_elevation": q_adjust_elevation,
    "adjust_latitude": q_adjust_latitude,
    "adjust_joint": q_adjust_joint,
    "report_city_female": q_report_city_female,
}
