"""Readers, sinks, contracts and the table reset."""

import json
import os

import pytest
from pyspark.sql import functions as F

from climastar.session import new_run_dir
from climastar.sources import contracts
from climastar.sources.readers import read_csv_strings, read_demographics_json
from climastar.sources.sinks import write_parquet_overwrite


def test_csv_all_strings_na_kept_empty_null(spark):
    d = new_run_dir(spark, "t-csv")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write("ident,continent,elevation_ft,iata_code\nA1,NA,12,\nA2,EU,,X\n")
    df = read_csv_strings(spark, d)
    assert all(t == "string" for _, t in df.dtypes)
    rows = sorted(df.collect())
    assert rows[0].continent == "NA" and rows[0].iata_code is None
    assert rows[1].elevation_ft is None


def test_json_lines_and_array(spark):
    d = new_run_dir(spark, "t-json")
    os.makedirs(d + "/lines")
    os.makedirs(d + "/array")
    recs = [{"city": "A", "Median Age": 30.5, "count": 3}, {"City": "B", "median_age": "31", "Count": 4}, {"City": "C"}]
    with open(d + "/lines/x.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    with open(d + "/array/x.json", "w") as f:
        f.write(json.dumps(recs, indent=2))
    a = read_demographics_json(spark, d + "/lines").collect()
    b = read_demographics_json(spark, d + "/array", multi_line=True).collect()
    assert sorted(a) == sorted(b)
    assert {(r.city, r.median_age, r["count"]) for r in a} == {("A", "30.5", "3"), ("B", "31", "4"), ("C", None, None)}


def test_overwrite_is_idempotent(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    path = new_run_dir(spark, "t-sink") + "/t"
    assert write_parquet_overwrite(df, path) == 10
    assert write_parquet_overwrite(df, path) == 10
    assert spark.read.parquet(path).count() == 10


def test_conform_tolerant_and_missing(spark):
    df = spark.createDataFrame([("Austin", "TX", "12.7", "CAL")],
                               "CITY string, state string, median_age string, state_code string")
    out = contracts.conform(df, "cities_demog")
    assert [f.name for f in out.schema.fields] == [c for c, _, _ in contracts.CONTRACTS["cities_demog"]]
    r = out.collect()[0]
    assert r.city == "Austin" and r.median_age == 12.7 and r.state_code == "CAL" and r.race is None


def test_constraint_violations_report_long_code(spark):
    from climastar.operators.quality import constraint_violations

    df = spark.createDataFrame([("Austin", "CAL"), ("Dallas", "TX"), (None, "T")], "city string, state_code string")
    rows = {(r.column, r.rule): r.violations for r in constraint_violations(df, "cities_demog").collect()}
    assert rows[("state_code", "max_length")] == 1
    assert rows[("city", "max_length")] == 0


def test_not_null_rule(spark):
    from climastar.operators.quality import constraint_violations

    df = spark.createDataFrame([(1.0,), (None,)], "average_temperature double")
    rows = {(r.column, r.rule): r.violations for r in constraint_violations(df, "city_surface_temps").collect()}
    assert rows[("average_temperature", "not_null")] == 1


def test_table_reset_starts_empty_and_enforces_rules(spark):
    base, db = new_run_dir(spark, "t-tables"), "climastar_reset_test"
    spark.sql("CREATE TABLE IF NOT EXISTS cities_demog (own INT) USING parquet")
    contracts.reset_tables(spark, ["cities_demog", "city_surface_temps"], base, db)
    ok = spark.createDataFrame([("Austin", "TX")], "city string, state_code string")
    contracts.load_table(ok, "cities_demog", db)
    assert spark.table(f"{db}.cities_demog").count() == 1
    contracts.reset_tables(spark, ["cities_demog", "city_surface_temps"], base, db)
    assert spark.table(f"{db}.cities_demog").count() == 0
    # the reset leaves no rows behind, and a user's own table alone
    files = [f for d, _, names in os.walk(base.replace("file:", "")) for f in names if f.startswith("part-")]
    assert files == [] and spark.table("cities_demog").columns == ["own"]
    bad = spark.createDataFrame([("Austin", "CAL")], "city string, state_code string")
    with pytest.raises(Exception, match="(?i)length|limit"):
        contracts.load_table(bad, "cities_demog", db)
    null = spark.createDataFrame([(2000, None)], "year int, average_temperature double")
    with pytest.raises(Exception, match="NULL in city_surface_temps.average_temperature"):
        contracts.load_table(null, "city_surface_temps", db)
    assert "NOT NULL" in contracts.create_table_sql("state_surface_temps", db)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    spark.sql("DROP TABLE cities_demog")


def test_conform_keeps_large_integers(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big, str(big + 2))], "cicid bigint, admnum string")
    r = contracts.conform(df, "immigration").first()
    assert (r.cicid, r.admnum) == (big, big + 2)


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from climastar.session import shared_root

    remote = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default),
                             sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(remote)
