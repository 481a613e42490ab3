"""Skew handling, quality checks, plan shape."""

from pyspark.sql import functions as F

from climastar.operators.joins import Side, fanout_join, grid_join, hot_keys
from climastar.operators.quality import duplicate_summary, long_key_summary, qa_report
from conftest import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _largest_task(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.sum("count"), F.count("p")).first()


def _plain(a, b):
    return a.join(b, a.k == b.ok).select("k", "v", "ok", "w")


def test_grid_join_equals_plain_join(spark):
    # one hot key with most rows, cold keys, NULL keys, and keys of one side only
    big = spark.range(5000).select(
        F.when(F.col("id") < 4000, F.lit("hot")).when(F.col("id") < 4900, F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        F.col("id").alias("v"))
    other = spark.createDataFrame([("hot", 1), ("hot", 2), ("hot", 2), ("k1", 3), ("k3", 4), ("zz", 5), (None, 6)], "ok string, w int")
    for cell in (7, 300, 10**9):
        assert _rows(fanout_join(big, other, "k", "ok", cell)) == _rows(_plain(big, other))


def test_few_rows_with_very_many_partners_are_spread(spark):
    """The key is hot through the other side alone."""
    big = spark.range(3).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    other = spark.range(200_000).select(F.lit("a").alias("ok"), F.col("id").alias("w"))
    joined = grid_join([Side(big, "k"), Side(other, "ok")], 1000, tasks=64)
    most, total, tasks = _largest_task(joined)
    assert total == 600_000 and tasks == 64 and most <= 3 * total / 64
    assert joined.distinct().count() == total


def test_identical_rows_are_spread(spark):
    big = spark.range(2000).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    other = spark.range(50).select(F.lit("a").alias("ok"), F.col("id").alias("w"))
    joined = grid_join([Side(big, "k"), Side(other, "ok")], 1000, tasks=64)
    most, total, tasks = _largest_task(joined)
    assert total == 100_000 and tasks >= 32 and most <= 6 * total / 64
    assert _rows(joined.groupBy("w").count()) == [(i, 2000) for i in range(50)]


def test_copied_rows_grow_with_the_input(spark):
    """Ten times the rows of both sides: a hundred times the output, but ten times the rows that are copied into cells."""
    def copied(n):
        a = spark.range(100 * n).select(F.lit("a").alias("k"), F.col("id").alias("v"))
        b = spark.range(10 * n).select(F.lit("a").alias("ok"), F.col("id").alias("w"))
        h = hot_keys([Side(a, "k", True), Side(b, "ok", True)], 1000, 4).first()
        assert h.s_0 * h.s_1 * 64 >= 0.9 * 1000 * n * n
        return 100 * n * h.g_1 + 10 * n * h.g_0

    assert copied(200) <= 12 * copied(20)


def test_long_keys(spark):
    """Any bigint, with duplicates and NULL."""
    keys = [0, 1, 63, 64, 64, -1, -64, -65, 2**63 - 1, -2**63, 1 << 33, (1 << 33) + 1, None, None]
    got = long_key_summary(spark.createDataFrame([(k,) for k in keys], "id long"), "id").first()
    assert (got.rows, got.distinct_ids) == (14, 12)
    assert tuple(long_key_summary(spark.range(0), "id").first()) == (0, 0)


def test_running_keys_shuffle_a_row_for_64(spark):
    plan = long_key_summary(spark.range(64_000, numPartitions=4), "id")
    masks = spark.range(64_000, numPartitions=4).groupBy(F.shiftright("id", 6)).count().count()
    assert masks == 1000 and tuple(plan.first()) == (64_000, 64_000)


def test_three_sides_and_equal_names(spark):
    a = spark.range(400).select((F.col("id") % 3).alias("k"), F.col("id").alias("x"))
    b = spark.range(90).select((F.col("id") % 2).alias("k"), F.col("id").alias("y"))
    c = spark.createDataFrame([(0, "p"), (0, "p"), (1, "q")], "k long, z string")
    got = grid_join([Side(a, "k", True), Side(b, "k", True), Side(c, "k")], 50, tasks=16).toDF("k1", "x", "k2", "y", "k3", "z")
    want = a.join(b, "k").join(c, "k").select(F.col("k").alias("k1"), "x", F.col("k").alias("k2"), "y", F.col("k").alias("k3"), "z")
    assert _rows(got) == _rows(want)


def test_fact_with_cut_cities(spark, monkeypatch):
    """Cells of 200 rows: every city of the fact is cut over its parts.
    The rows are those of the uncut fact, no task has a whole city, and
    nothing runs while the plan is built."""
    from climastar.operators import joins
    from climastar.plans.catalog import clean_inputs
    from climastar.plans.model import build_fact, fact_parts, join_parts

    c = clean_inputs(spark, SF001)
    whole = build_fact(c.temperatures, c.airports, c.demographics).cache()
    monkeypatch.setattr(joins, "ROWS_PER_CELL", 200)
    spark.sparkContext.setJobGroup("planning", "the fact's plan")
    cut = join_parts(*fact_parts(c.temperatures, c.airports, c.demographics), "stable", tasks=64)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    spark.sparkContext.setJobGroup("other", "")
    most, total, tasks = _largest_task(cut)
    assert total == whole.count() and tasks >= 32 and most <= 5 * total / 64
    assert cut.select("id").exceptAll(whole.select("id")).count() == 0
    whole.unpersist()


def test_duplicate_check_detects_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "x int, y string")
    r = duplicate_summary(df, "t").collect()[0]
    assert (r.rows, r.distinct_rows, r.duplicates, r.passed) == (5, 3, 2, False)


def test_qa_report_flags_count_mismatch(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    rows = {(r.table, r.check): r.passed for r in qa_report({"t": 3}, {"t": df}, {}).collect()}
    assert rows == {("t", "row_count"): False, ("t", "duplicates"): True}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_plan_has_no_star_join_and_no_python(spark):
    from climastar.plans.catalog import model
    from climastar.plans.reports import report_city_climate

    m = model(spark, SF001)
    plan = _plan(report_city_climate(m))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the mean is taken from the distinct temperature rows, not the fact
    logical = report_city_climate(m)._jdf.queryExecution().optimizedPlan().toString()
    assert "ident" not in logical


def test_country_filter_reaches_scan(spark):
    from climastar.plans.catalog import cleaned

    plan = _plan(cleaned(spark, SF001, "temperatures"))
    assert "EqualTo(r_name,AMERICA)" in plan


def test_star_join_equals_preaggregated(spark):
    """The reference computes the report over fact x demographics x airports;
    the shipped plan aggregates first.  Same rows at sf0.01."""
    from climastar.plans.catalog import model
    from climastar.plans.reports import report_city_climate

    m = model(spark, SF001)
    f, d, a = m.fact.alias("f"), m.dim_demographics.alias("d"), m.dim_airport.alias("a")
    star = (f.join(d, F.col("f.city") == F.col("d.city")).join(a, F.col("f.city") == F.col("a.municipality"))
            .groupBy(F.col("f.city").alias("city"))
            .agg(F.round(F.avg("f.average_temperature"), 6).alias("average_temperature"),
                 F.min_by(F.col("d.total_population"),
                          F.struct("d.state", "d.race", "d.total_population")).alias("total_population"),
                 F.count_distinct("a.airport_name").alias("total_airports")))
    assert _rows(star) == _rows(report_city_climate(m))


def test_fact_is_dealt_to_a_stated_number_of_tasks(spark):
    """All sides by key and cell to as many tasks as the session has shuffle
    partitions, which adaptive execution does not coalesce; no broadcast hint."""
    from climastar.plans.catalog import model

    fact = model(spark, SF001).fact
    assert "REPARTITION_BY_NUM" in _plan(fact)
    assert "rightHint=(strategy=broadcast)" not in fact._jdf.queryExecution().optimizedPlan().toString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fact.rdd.getNumPartitions() == n


def test_dimension_queries_touch_their_own_tables(spark):
    from climastar.plans.catalog import QUERIES

    for name, table in (("dim_airport", "supplier"), ("clean_airports", "supplier"), ("dim_demographics", "customer")):
        files = {f.rsplit("/", 1)[1] for f in QUERIES[name](spark, SF001).inputFiles()}
        assert files == {f"{table}.parquet", "nation.parquet", "region.parquet"}


def test_stored_report_reads_two_fact_columns(spark):
    from climastar.plans.catalog import model
    from climastar.plans.model import read_model, write_model
    from climastar.plans.reports import report_city_climate
    from climastar.session import new_run_dir

    d = new_run_dir(spark, "t-plan")
    write_model(model(spark, SF001), d)
    plan = _plan(report_city_climate(read_model(spark, d)))
    assert "ReadSchema: struct<average_temperature:double,city:string>" in plan or \
           "struct<average_temperature:double,city:string>" in plan


def test_duplicate_check_shuffles_fingerprints_only(spark):
    from climastar.plans.catalog import model
    from climastar.plans.model import FACT_COLUMNS

    plan = _plan(duplicate_summary(model(spark, SF001).fact, "f", FACT_COLUMNS))
    exchanges = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]
    fp = [l for l in exchanges if "__fp1" in l and "__fp2" in l]
    assert fp and all("ident" not in l for l in fp)


def test_fact_rows_from_parts_equal_counted_fact(spark):
    from climastar.plans.catalog import model
    from climastar.plans.model import StarModel
    from climastar.plans.reports import city_fact_rows

    m = model(spark, SF001)
    counted = city_fact_rows(StarModel(m.fact, m.dim_airport, m.dim_demographics))
    assert _rows(city_fact_rows(m)) == _rows(counted)
    # the fact (and the exchange of its cells) is never generated
    assert "REPARTITION_BY_NUM" not in _plan(city_fact_rows(m))


def test_unreadable_and_wrong_tables_are_reported(spark, tmp_path):
    import os

    from pyspark.sql import types as T

    from climastar.operators.quality import readable

    want = T.StructType.fromDDL("x int, y string")
    spark.createDataFrame([(1, "a"), (2, None)], want).write.parquet(f"{tmp_path}/good")
    spark.createDataFrame([("1", "a")], "x string, y string").write.parquet(f"{tmp_path}/typed")
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_path}/narrow")
    spark.range(20000).selectExpr("cast(id as int) x", "uuid() y").coalesce(1).write.parquet(f"{tmp_path}/cut")
    part = next(f for f in os.listdir(tmp_path / "cut") if f.startswith("part-"))
    data = (tmp_path / "cut" / part).read_bytes()
    (tmp_path / "cut" / part).write_bytes(data[:len(data) // 2])
    for f in os.listdir(tmp_path / "cut"):
        if f.endswith(".crc"):
            os.remove(tmp_path / "cut" / f)
    names = ["good", "typed", "narrow", "cut", "absent"]
    got = {r.table: (r.readable, r.schema_matches) for r in readable(spark, {n: f"{tmp_path}/{n}" for n in names}, dict.fromkeys(names, want)).collect()}
    assert got == {"good": (True, True), "typed": (True, False), "narrow": (True, False), "cut": (False, False), "absent": (False, False)}


def test_rows_of_a_join_are_counted_without_forming_them(spark, monkeypatch):
    """3000 x 3000 x 3000 rows of one city, and a city that one part lacks."""
    from climastar.plans import catalog
    from climastar.plans.clean import CleanInputs
    from climastar.plans.model import table_schema

    def rows(name, city, fields, value):
        types = {f.name: f.dataType for n in ("fact_table", "dimension_table_airport", "dimension_table_demographics") for f in table_schema(n).fields}
        df = spark.range(3001)
        cols = [F.when(F.col("id") < 3000, F.lit("a")).otherwise(F.lit(name)).alias(city)]
        return df.select(*cols, *[(F.col("id") if c == value else F.lit(None)).cast(types[c]).alias(c) for c in fields])

    inputs = CleanInputs(
        rows("b", "city", ["average_temperature", "average_temperature_uncertainty", "country", "year", "mon"], "average_temperature"),
        rows("b", "municipality", ["ident", "type", "airport_name", "elevation_ft", "continent", "iso_country", "iso_region", "gps_code", "iata_code",
                                   "local_code", "latitude", "longitude"], "ident"),
        rows("c", "city", ["state", "median_age", "male_population", "female_population", "total_population", "veteran_population", "foreign_born",
                           "ave_household_size", "state_code", "race", "count"], "total_population"))
    monkeypatch.setattr(catalog, "clean_inputs", lambda spark, sf: inputs)
    df = catalog.q_agg_count(spark, "")
    assert "explode" not in df._jdf.queryExecution().optimizedPlan().toString()      # the cells of the grid join
    assert {r["table"]: r["rows"] for r in df.collect()}["fact_table"] == 3000 ** 3
