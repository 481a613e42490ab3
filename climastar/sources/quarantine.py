"""Quarantine load: rows that break a declared rule go to a table of rejected rows, with the rules they break.

The input is scanned once: it is conformed, judged and written to a staging
folder in two partitions, from which both tables are loaded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from climastar.session import new_run_dir
from climastar.sources.contracts import Rule, conform, constraint_rules, contract_schema, load_table

REJECTED = "{}_rejected"


def broken_rule(rule: Rule) -> Column:
    """The rule's text if a conformed row breaks it, else NULL."""
    col = F.col(f"`{rule.column}`")
    if rule.rule == "not_null":
        return F.when(col.isNull(), F.lit(f"{rule.column}: not null"))
    return F.when(F.length(col) > rule.limit, F.lit(f"{rule.column}: at most {rule.limit} characters"))


def judged(df: DataFrame, table: str) -> DataFrame:
    """``df`` conformed to the contract, with ``violations``: the broken rules in declared order, an empty array without one."""
    rules = constraint_rules(table)
    found = F.array_compact(F.array(*map(broken_rule, rules))) if rules else F.array().cast("array<string>")
    return conform(df, table).withColumn("violations", found)


@dataclass(frozen=True)
class Load:
    table: str
    rows: int
    accepted: int
    rejected: int


def rejected_table_sql(table: str, database: str) -> str:
    """Table of rejected rows: the contract's columns without their lengths, and the broken rules."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract_schema(table).fields)
    return f"CREATE TABLE IF NOT EXISTS `{database}`.`{REJECTED.format(table)}` ({cols}, violations array<string>) USING parquet"


def quarantine_load(spark: SparkSession, df: DataFrame, table: str, database: str) -> Load:
    """Append the rows of ``df`` that keep all rules to ``table`` and the others to its table of rejected rows.  Every row
    goes to exactly one of them; the counts are observed during the one scan of the input."""
    seen = Observation(f"quarantine {table}")
    bad = F.size("violations") > 0
    stage = new_run_dir(spark, f"quarantine-{table}")
    rows = judged(df, table)
    (rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("rejected"))
     .withColumn("rejected", bad).write.partitionBy("rejected").parquet(stage))
    counts = seen.get
    staged = spark.read.schema(rows.schema.add("rejected", "boolean")).parquet(stage)
    spark.sql(rejected_table_sql(table, database))
    if counts["rows"] > counts["rejected"]:
        load_table(staged.where("not rejected").drop("rejected", "violations"), table, database)
    if counts["rejected"]:
        staged.where("rejected").drop("rejected").write.insertInto(f"`{database}`.`{REJECTED.format(table)}`")
    return Load(table, counts["rows"], counts["rows"] - counts["rejected"], counts["rejected"])
