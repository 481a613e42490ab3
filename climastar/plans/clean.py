"""Cleansed sources: rename, filter, parse and type the three raw inputs.

Each function is a single projection over its input plus one filter, so
Catalyst pushes the country filter into the scan (or, for the stand-ins,
through the joins down to the region table) and prunes every column that
no output uses.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climastar.functions import (
    date_month, date_year, hemisphere_coordinate, split_part, to_double, to_int, to_text,
)
from climastar.operators.filters import drop_missing, equals
from climastar.operators.projection import rename
from climastar.operators.quality import EmptySourceError, ensure_non_empty
from climastar.sources.readers import DEMOGRAPHICS_SPELLINGS

# Column names of the surface-temperature file and their new names.
TEMPERATURE_RENAMES = {
    "dt": "date",
    "AverageTemperature": "average_temperature",
    "AverageTemperatureUncertainty": "average_temperature_uncertainty",
    "City": "city",
    "Country": "country",
    "Latitude": "latitude",
    "Longitude": "longitude",
}

# The airport file's name column is renamed.
AIRPORT_RENAMES = {"name": "airport_name"}

# Filter values of the source job.
US_COUNTRY_CODE = "US"
US_COUNTRY_NAME = "United States"


def _coalesce_spellings(df: DataFrame, spellings: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    exact = set(df.columns)
    lower = {c.lower(): c for c in df.columns}
    out = {}
    for canonical, names in spellings.items():
        present = [n for n in names if n in exact]
        if not present:
            present = [lower[n.lower()] for n in names if n.lower() in lower][:1]
        out[canonical] = (F.coalesce(*[F.col(f"`{n}`") for n in present]) if present
                          else F.lit(None).cast("string"))
    return out


def clean_temperatures(raw: DataFrame, country: str = US_COUNTRY_NAME,
                       check: bool = True) -> DataFrame:
    """year, mon, average_temperature, average_temperature_uncertainty, city,
    country, latitude, longitude; rows without a usable measure dropped."""
    t = equals(rename(raw, TEMPERATURE_RENAMES), "country", country)
    t = t.select(
        date_year("date").alias("year"),
        date_month("date").alias("mon"),
        to_double("average_temperature").alias("average_temperature"),
        to_double("average_temperature_uncertainty").alias("average_temperature_uncertainty"),
        to_text("city").alias("city"),
        to_text("country").alias("country"),
        hemisphere_coordinate("latitude").alias("latitude"),
        hemisphere_coordinate("longitude").alias("longitude"),
    )
    t = drop_missing(t, ["average_temperature"])
    return ensure_non_empty(t, "temperatures") if check else t


def clean_airports(raw: DataFrame, country_code: str = US_COUNTRY_CODE,
                   check: bool = True) -> DataFrame:
    """Airports of one country, coordinates split into latitude/longitude."""
    a = equals(rename(raw, AIRPORT_RENAMES), "iso_country", country_code)
    text = ["ident", "type", "airport_name"]
    a = a.select(
        *[to_text(c).alias(c) for c in text],
        to_int("elevation_ft").alias("elevation_ft"),
        *[to_text(c).alias(c) for c in ("continent", "iso_country", "iso_region", "municipality",
                                         "gps_code", "iata_code", "local_code")],
        to_double(split_part("coordinates", ", ", 1)).alias("latitude"),
        to_double(split_part("coordinates", ", ", 0)).alias("longitude"),
    )
    return ensure_non_empty(a, "airports") if check else a


def clean_demographics(raw: DataFrame, check: bool = True) -> DataFrame:
    """One row per (city, state, race), typed."""
    c = _coalesce_spellings(raw, DEMOGRAPHICS_SPELLINGS)
    d = raw.select(
        to_text(c["city"]).alias("city"),
        to_text(c["state"]).alias("state"),
        to_double(c["median_age"]).alias("median_age"),
        to_int(c["male_population"]).alias("male_population"),
        to_int(c["female_population"]).alias("female_population"),
        to_int(c["total_population"]).alias("total_population"),
        to_int(c["veteran_population"]).alias("veteran_population"),
        to_int(c["foreign_born"]).alias("foreign_born"),
        to_double(c["ave_household_size"]).alias("ave_household_size"),
        to_text(c["state_code"]).alias("state_code"),
        to_text(c["race"]).alias("race"),
        to_int(c["count"]).alias("count"),
    )
    return ensure_non_empty(d, "demographics") if check else d


@dataclass
class CleanInputs:
    temperatures: DataFrame
    airports: DataFrame
    demographics: DataFrame


#: The column of each input that the model joins on.
JOIN_KEYS = {"temperatures": "city", "airports": "municipality", "demographics": "city"}


def gate(tables: Mapping[str, DataFrame]) -> None:
    """Stop when an input has no row that can be joined: it is empty, or its
    join key is NULL throughout (as when no field had an accepted name).

    Each check is an incremental take (``isEmpty``), and they are submitted
    together; inputs that are not passed are not touched.
    """
    from concurrent.futures import ThreadPoolExecutor

    def usable(item) -> tuple[str, bool]:
        name, df = item
        return name, not df.where(F.col(JOIN_KEYS[name]).isNotNull()).select(JOIN_KEYS[name]).isEmpty()

    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        for name, ok in pool.map(usable, tables.items()):
            if not ok:
                raise EmptySourceError(f"{name}: no rows with a {JOIN_KEYS[name]} to process")


def clean_all(temperatures_raw: DataFrame, airports_raw: DataFrame, demographics_raw: DataFrame,
              country_code: str = US_COUNTRY_CODE, country_name: str = US_COUNTRY_NAME,
              check: bool = True) -> CleanInputs:
    """Clean the three inputs; with ``check`` each must have a usable row (``gate``)."""
    c = CleanInputs(clean_temperatures(temperatures_raw, country_name, check=False),
                    clean_airports(airports_raw, country_code, check=False),
                    clean_demographics(demographics_raw, check=False))
    if check:
        gate({"temperatures": c.temperatures, "airports": c.airports, "demographics": c.demographics})
    return c
