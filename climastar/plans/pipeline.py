"""The whole batch: read -> clean -> build -> write -> QA -> reports.

Differences from the source job, all deliberate:

* one scan per source: cleaned airports and demographics are written once
  and the dimensions, the counts and the fact are built from the written
  rows; temperatures are scanned by the write of their distinct rows; row
  counts come from the writes (``Observation``);
* an input without a usable join key, or an empty fact, stops the run;
* QA and reports read the written tables, which also cuts the lineage: a
  lost executor costs a re-read of Parquet, not a rebuild from the raw files;
* the fact is de-duplicated on its business columns before the key is
  added, so the duplicate check can fail;
* a failed check raises (optionally) instead of only printing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from climastar.operators.quality import EmptySourceError, qa_report
from climastar.plans.clean import JOIN_KEYS, US_COUNTRY_CODE, US_COUNTRY_NAME, clean_all
from climastar.plans.model import (
    DIM_AIRPORT_COLUMNS, DIM_DEMOGRAPHICS_COLUMNS, FACT_COLUMNS, model_from_clean, read_model,
    write_model,
)
from climastar.plans.reports import report_city_climate, report_city_veterans
from climastar.sources.readers import (
    read_csv_strings, read_demographics_json, source_path,
)

# File names of the public inputs, relative to the input base.
AIRPORT_FILE = "airport-codes_csv.csv"
DEMOGRAPHICS_FILE = "us-cities-demographics.json"
TEMPERATURE_FILE_MAJOR = "Surface_Temps/GlobalLandTemperaturesByMajorCity.csv"
TEMPERATURE_FILE_ALL = "Surface_Temps/GlobalLandTemperaturesByCity.csv"


@dataclass
class RawInputs:
    temperatures: DataFrame
    airports: DataFrame
    demographics: DataFrame


def read_inputs(spark: SparkSession, base: str, all_cities: bool = False,
                multi_line: bool = False) -> RawInputs:
    """The three public inputs under ``base`` (any URI scheme).
    ``all_cities`` takes the full temperature file; ``multi_line`` a
    demographics file that holds one array."""
    temp_file = TEMPERATURE_FILE_ALL if all_cities else TEMPERATURE_FILE_MAJOR
    return RawInputs(
        temperatures=read_csv_strings(spark, source_path(base, temp_file)),
        airports=read_csv_strings(spark, source_path(base, AIRPORT_FILE)),
        demographics=read_demographics_json(spark, source_path(base, DEMOGRAPHICS_FILE), multi_line),
    )


@dataclass
class PipelineResult:
    output: str
    rows_written: dict[str, int]
    qa: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)


class QualityCheckFailed(RuntimeError):
    pass


def _written(spark: SparkSession, df: DataFrame, path: str, name: str) -> DataFrame:
    """Write a cleaned input and read it back; stop if no row has its join key."""
    usable = Observation(f"usable {name}")
    (df.observe(usable, F.count(F.col(JOIN_KEYS[name])).alias("rows")).write.mode("overwrite").parquet(path))
    if usable.get["rows"] == 0:
        raise EmptySourceError(f"{name}: no rows with a {JOIN_KEYS[name]} to process")
    return spark.read.schema(df.schema).parquet(path)


def run_pipeline(spark: SparkSession, inputs: RawInputs, output: str,
                 country_code: str = US_COUNTRY_CODE, country_name: str = US_COUNTRY_NAME,
                 key: str = "stable", fail_on_qa: bool = False) -> PipelineResult:
    clean = clean_all(inputs.temperatures, inputs.airports, inputs.demographics,
                      country_code, country_name, check=False)
    clean.airports, clean.demographics = (
        _written(spark, df, source_path(output, f"clean_{name}"), name)
        for name, df in (("airports", clean.airports), ("demographics", clean.demographics)))
    written = write_model(model_from_clean(clean, key=key), output)
    if written["fact_table"] == 0:
        raise EmptySourceError("the fact is empty: no temperatures, or no city that all three inputs have")

    stored = read_model(spark, output, key)
    # Duplicates of the business rows.  The stable key is a hash of exactly
    # those columns, so equal rows have equal keys and grouping on the key
    # (one column instead of twenty) finds every duplicate; a monotonic key
    # is unique per row and cannot be used.
    dedup_cols = {"fact_table": ["id"] if key == "stable" else FACT_COLUMNS,
                  "dimension_table_airport": DIM_AIRPORT_COLUMNS,
                  "dimension_table_demographics": DIM_DEMOGRAPHICS_COLUMNS}
    qa = qa_report(written, stored.tables(), dedup_cols)
    if fail_on_qa:
        failed = qa.filter("NOT passed").limit(1).collect()
        if failed:
            raise QualityCheckFailed(f"QA failed: {failed[0].asDict()}")
    reports = {"report_city_climate": report_city_climate(stored),
               "report_city_veterans": report_city_veterans(stored)}
    return PipelineResult(output, written, qa, reports)
