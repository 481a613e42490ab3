"""Batch readers.  Every reader takes a base URI and a relative name, so the
same code reads ``file:``, ``hdfs://`` or object-store locations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def source_path(base: str, name: str) -> str:
    """Join a base URI and a relative name without touching the scheme."""
    return base.rstrip("/") + "/" + name.lstrip("/")


def read_csv_strings(spark: SparkSession, path: str,
                     schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row, every column as string (no inference pass).

    Without ``schema`` the column names come from the header line; with one,
    the header is checked against it (``enforceSchema`` off) so a reordered
    file fails loudly instead of shifting values between columns.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
              multi_line: bool = False) -> DataFrame:
    """JSON lines (or arrays with ``multi_line=True``).

    A declared schema avoids the inference scan over the whole input; field
    names then match case-sensitively.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


# Accepted names of each demographics field, first that of the
# published table.
DEMOGRAPHICS_SPELLINGS = {
    "city": ["city", "City"],
    "state": ["state", "State"],
    "median_age": ["median_age", "Median Age"],
    "male_population": ["male_population", "Male Population"],
    "female_population": ["female_population", "Female Population"],
    "total_population": ["total_population", "Total Population"],
    "veteran_population": ["veteran_population", "number_of_veterans", "Number of Veterans"],
    "foreign_born": ["foreign_born", "Foreign-born"],
    "ave_household_size": ["ave_household_size", "average_household_size", "Average Household Size"],
    "state_code": ["state_code", "State Code"],
    "race": ["race", "Race"],
    "count": ["count", "Count"],
}


def read_demographics_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """City demographics JSON, every field as text under its published name.

    Each object is read as a map, so that the names need not be known or
    inferred beforehand and may differ from record to record.  JSON lines are
    split among tasks; ``multi_line`` takes files that hold one array or one
    object over several lines, a file per task as such files have no
    boundary to split at.
    """
    if multi_line:
        docs = spark.read.text(path, wholetext=True)
        # an object alone counts as an array of one
        text = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
        fields = docs.select(F.explode(F.from_json(text, "array<map<string,string>>")).alias("m"))
    else:
        fields = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("m")).where("m is not null")
    return fields.select(*[F.coalesce(*[F.try_element_at("m", F.lit(n)) for n in names]).alias(c)
                           for c, names in DEMOGRAPHICS_SPELLINGS.items()])


@dataclass
class Checked:
    """A scan with its damaged records: ``rows`` has column ``malformed``, the text of a record that could not be read, NULL for a good
    one.  ``counts()`` gives the records and the malformed ones, observed during the first full scan of ``rows``."""

    rows: DataFrame
    observed: Observation

    @property
    def records(self) -> DataFrame:
        return self.rows.where("malformed is null").drop("malformed")

    @property
    def damaged(self) -> DataFrame:
        """The texts of the damaged records."""
        return self.rows.where("malformed is not null").select("malformed")

    def counts(self) -> tuple[int, int]:
        got = self.observed.get
        return got["records"], got["malformed"]


def _checked(rows: DataFrame) -> Checked:
    seen = Observation()
    return Checked(rows.observe(seen, F.count(F.lit(1)).alias("records"), F.count("malformed").alias("malformed")), seen)


def read_csv_checked(spark: SparkSession, path: str, columns: Sequence[str]) -> Checked:
    """CSV with a header row and the given columns, all text.  A line with fewer or more fields, or with a quote that does not end, is
    malformed and keeps its text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "malformed")])
    rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "malformed")
            .option("enforceSchema", True).option("columnPruning", False).csv(path))     # else a short line shows only if its last field is asked for
    # Spark refuses to read the text of damaged lines alone; this one also asks for nothing of the first field.
    text = F.concat("malformed", F.substring(F.coalesce(F.col(f"`{columns[0]}`"), F.lit("")), 1, 0))
    return _checked(rows.withColumn("malformed", text))


def read_demographics_checked(spark: SparkSession, path: str) -> Checked:
    """City demographics in JSON lines, as ``read_demographics_json`` reads them; a line that is no JSON object is malformed and keeps its
    text.  Blank lines are no records."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}).alias("m"))
    fields = [F.coalesce(*[F.try_element_at("m", F.lit(n)) for n in names]).alias(c) for c, names in DEMOGRAPHICS_SPELLINGS.items()]
    return _checked(parsed.select(*fields, F.when(F.col("m").isNull(), F.col("value")).alias("malformed")))


def read_parquet(spark: SparkSession, path: str,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; a column list shows up as the scan's ReadSchema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
