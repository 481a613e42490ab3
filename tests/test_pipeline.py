"""End-to-end batch and rerun properties."""

import json
import os

import pytest

from climastar.plans.catalog import raw_inputs
from climastar.plans.pipeline import run_pipeline
from climastar.session import new_run_dir
from climastar.sources.standins import STANDIN_COUNTRY
from conftest import SF001


def test_pipeline_rerun_same_rows_and_qa_passes(spark):
    out = new_run_dir(spark, "t-pipe")
    raw = raw_inputs(spark, SF001)
    r1 = run_pipeline(spark, raw, out, STANDIN_COUNTRY, STANDIN_COUNTRY, fail_on_qa=True)
    ids1 = sorted(r.id for r in spark.read.parquet(out + "/fact_table").select("id").collect())
    r2 = run_pipeline(spark, raw, out, STANDIN_COUNTRY, STANDIN_COUNTRY, fail_on_qa=True)
    ids2 = sorted(r.id for r in spark.read.parquet(out + "/fact_table").select("id").collect())
    assert r1.rows_written == r2.rows_written
    assert ids1 == ids2 and len(ids1) == len(set(ids1)) == r1.rows_written["fact_table"]
    assert all(r.passed for r in r2.qa.collect())
    assert r2.reports["report_city_climate"].count() == 5


def test_monotonic_ids_unique(spark):
    from climastar.plans.catalog import QUERIES

    r = QUERIES["surrogate_key_monotonic"](spark, SF001).first()
    assert r.passed and r.rows == r.distinct_ids > 0


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["city", "average_temperature", "total_population", "total_airports"]
    assert df.count() > 0


def test_sized_fact_write_equals_lazy_fact(spark):
    from climastar.plans.catalog import model
    from climastar.plans.model import write_fact

    m = model(spark, SF001)
    path = new_run_dir(spark, "t-fact") + "/fact"
    n = write_fact(m.source, path)
    stored = spark.read.parquet(path)
    assert n == stored.count() == m.fact.count()
    assert stored.select("id").subtract(m.fact.select("id")).count() == 0
    assert stored.rdd.getNumPartitions() >= 1


def test_fact_write_tasks_follow_fact_rows(spark, monkeypatch):
    """With 5,000 fact rows per task, the ~46k-row fact at sf0.01 is written
    by 10 tasks (more than the 8 local slots), none of them with most rows."""
    import climastar.plans.model as M
    from climastar.plans.catalog import model

    monkeypatch.setattr(M, "FACT_ROWS_PER_TASK", 5000)
    monkeypatch.setattr("climastar.operators.joins.ROWS_PER_CELL", 1000)
    m = model(spark, SF001)
    path = new_run_dir(spark, "t-fact-sized") + "/fact"
    n = M.write_fact(m.source, path)
    files = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_name").count().collect()]
    assert len(files) == -(-n // 5000) == 10 and max(files) <= 3 * n / 10


def test_fact_write_empties_its_staging(spark, monkeypatch):
    """Also when the write fails."""
    import climastar.plans.model as M
    from climastar.plans.catalog import model

    m = model(spark, SF001)
    good = new_run_dir(spark, "t-stage") + "/fact"
    M.write_fact(m.source, good)
    assert spark.read.parquet(good + ".parts").count() == 0

    def fail(*args, **kwargs):
        raise OSError("no space")
    monkeypatch.setattr(M, "write_parquet_overwrite", fail)
    bad = new_run_dir(spark, "t-stage") + "/fact"
    with pytest.raises(OSError):
        M.write_fact(m.source, bad)
    assert spark.read.parquet(bad + ".parts").count() == 0


def test_pipeline_from_files_in_public_layout(spark):
    """The raw inputs written as files named like the public datasets, read
    by ``read_inputs`` and run end to end, give the same tables as the
    in-memory stand-ins."""
    from climastar.plans.pipeline import (
        AIRPORT_FILE, DEMOGRAPHICS_FILE, TEMPERATURE_FILE_ALL, TEMPERATURE_FILE_MAJOR, read_inputs,
    )

    raw = raw_inputs(spark, SF001)
    base = new_run_dir(spark, "t-files")
    raw.airports.write.option("header", True).csv(f"{base}/{AIRPORT_FILE}")
    raw.demographics.write.json(f"{base}/{DEMOGRAPHICS_FILE}")
    raw.temperatures.write.option("header", True).csv(f"{base}/{TEMPERATURE_FILE_MAJOR}")
    from_files = run_pipeline(spark, read_inputs(spark, base), new_run_dir(spark, "t-files-out"),
                              STANDIN_COUNTRY, STANDIN_COUNTRY, fail_on_qa=True)
    in_memory = run_pipeline(spark, raw, new_run_dir(spark, "t-mem-out"),
                             STANDIN_COUNTRY, STANDIN_COUNTRY)
    assert from_files.rows_written == in_memory.rows_written
    everything = new_run_dir(spark, "t-files-all")
    raw.airports.write.option("header", True).csv(f"{everything}/{AIRPORT_FILE}")
    titles = {"city": "City", "state": "State", "race": "Race", "count": "Count", "total_population": "Total Population"}
    records = [{titles.get(k, k): v for k, v in r.asDict().items()} for r in raw.demographics.collect()]
    os.makedirs(f"{everything}/{DEMOGRAPHICS_FILE}".replace("file:", ""))
    with open(f"{everything}/{DEMOGRAPHICS_FILE}/array.json".replace("file:", ""), "w") as f:
        json.dump(records, f, indent=1)
    raw.temperatures.write.option("header", True).csv(f"{everything}/{TEMPERATURE_FILE_ALL}")
    full = run_pipeline(spark, read_inputs(spark, everything, all_cities=True, multi_line=True), new_run_dir(spark, "t-all-out"),
                        STANDIN_COUNTRY, STANDIN_COUNTRY, fail_on_qa=True)
    assert full.rows_written == from_files.rows_written
    a = from_files.reports["report_city_climate"]
    b = in_memory.reports["report_city_climate"]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_pipeline_monotonic_key_reads_back(spark):
    out = new_run_dir(spark, "t-mono")
    r = run_pipeline(spark, raw_inputs(spark, SF001), out, STANDIN_COUNTRY, STANDIN_COUNTRY,
                     key="monotonic", fail_on_qa=True)
    assert all(x.passed for x in r.qa.collect())


def test_nearly_equal_rows_pass_and_empty_fact_raises(spark):
    """Four distinct temperature rows that rounding or joined text would
    merge stay four facts with four keys; a batch whose cities do not meet stops."""
    from climastar.operators.quality import EmptySourceError
    from climastar.plans.pipeline import RawInputs
    from test_model import airport, airports, demo, demographics, t, temps

    A = airports(spark, [airport("P1", "PDX", "Portland")])
    D = demographics(spark, [demo("Portland", "Oregon", "1")])
    T = temps(spark, [t("Portland", v) for v in ("10.0000001", "10.0000002", "1e13", "2e13")])
    r = run_pipeline(spark, RawInputs(T, A, D), new_run_dir(spark, "t-near"), fail_on_qa=True)
    assert r.rows_written["fact_table"] == 4
    with pytest.raises(EmptySourceError, match="fact"):
        run_pipeline(spark, RawInputs(temps(spark, [t("Salem", "1.0")]), A, D), new_run_dir(spark, "t-none"))
    with pytest.raises(EmptySourceError, match="demographics"):
        run_pipeline(spark, RawInputs(T, A, demographics(spark, [demo(None, "Oregon", "1")])), new_run_dir(spark, "t-none"))


def test_one_scan_per_source(spark):
    """Every row of every input is read exactly once by the batch."""
    raw = raw_inputs(spark, SF001)
    base = new_run_dir(spark, "t-scan")
    for name, df in (("t", raw.temperatures), ("a", raw.airports), ("d", raw.demographics)):
        df.write.parquet(f"{base}/{name}")
    counters = {n: spark.sparkContext.accumulator(0) for n in "tad"}

    def counted(name):
        df = spark.read.parquet(f"{base}/{name}")
        acc = counters[name]

        def pass_on(batches):
            for b in batches:
                acc.add(b.num_rows)
                yield b
        return df.mapInArrow(pass_on, df.schema), df.count()

    from climastar.plans.pipeline import RawInputs
    frames = {n: counted(n) for n in "tad"}
    run_pipeline(spark, RawInputs(*(frames[n][0] for n in "tad")), new_run_dir(spark, "t-scan-out"), STANDIN_COUNTRY, STANDIN_COUNTRY)
    assert {n: counters[n].value for n in "tad"} == {n: frames[n][1] for n in "tad"}
