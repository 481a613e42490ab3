"""Publication, quarantine, malformed records, content and file checks, incremental rebuild, clustering."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF0001

from climastar.operators.quality import audit_files, content_match, file_manifest
from climastar.plans.colocated import bucket_count, colocated_fact, read_colocated, write_colocated
from climastar.plans.incremental import read_fact, rebuild_fact
from climastar.plans.model import FactSource, StarModel, build_fact, build_model
from climastar.plans.reports import adjust_joint, city_mean_temperature, influence_certainty, poisson_steps, report_city_climate, report_city_veterans
from climastar.session import new_run_dir
from climastar.sources import contracts, publish as pub
from climastar.sources.quarantine import quarantine_load
from climastar.sources.readers import read_csv_checked, read_demographics_checked, source_path
from climastar.sources.sinks import clustered, write_parquet_overwrite, write_parquet_receipt


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def write_text(folder, name, text, mode="w"):
    os.makedirs(local(folder), exist_ok=True)
    with open(f"{local(folder)}/{name}", mode) as f:
        f.write(text)


# --- atomic publication

def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def writer(df, name="t"):
    return lambda path: {name: write_parquet_overwrite(df, source_path(path, name))}


def test_readers_see_the_last_committed_version(spark):
    base = new_run_dir(spark, "t-publish")
    with pytest.raises(pub.NotPublished):
        pub.read_published(spark, base, "t")
    one = pub.publish(spark, base, writer(numbers(spark, 1, 2)))
    old = pub.read_published(spark, base, "t")
    two = pub.publish(spark, base, writer(numbers(spark, 3)))
    assert (one.version, two.version, one.rows, two.rows) == (1, 2, {"t": 2}, {"t": 1})
    assert sorted(r.v for r in old.collect()) == [1, 2]                          # a reader that began before goes on
    assert [r.v for r in pub.read_published(spark, base, "t").collect()] == [3]
    assert sorted(r.v for r in pub.read_published(spark, base, "t", version=1).collect()) == [1, 2]
    assert [tuple(r) for r in pub.history(spark, base).collect()] == [(1, "t", 2), (2, "t", 1)]
    with pytest.raises(pub.NotPublished):
        pub.resolve(spark, base, 3)


def test_a_write_that_dies_midway_changes_nothing(spark):
    base = new_run_dir(spark, "t-publish")
    pub.publish(spark, base, writer(numbers(spark, 1)))

    def dies(path):
        write_parquet_overwrite(numbers(spark, 7), source_path(path, "t"))     # the first table is there
        bad = numbers(spark, 8, 9).withColumn("v", F.when(F.col("v") == 9, F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("v")))
        return {"t": 1, "u": write_parquet_overwrite(bad, source_path(path, "u"))}

    with pytest.raises(Exception, match="killed"):
        pub.publish(spark, base, dies)
    # The commit itself may die too: what it leaves is no record yet.
    write_text(f"{base}/commits/000000000002-dead/_temporary/0", "part-0.json", '{"version":2,"id":"dead","rows":{}}')
    assert [c.version for c in pub.commits(spark, base)] == [1]
    assert [r.v for r in pub.read_published(spark, base, "t").collect()] == [1]
    assert pub.publish(spark, base, writer(numbers(spark, 5))).version == 2


def test_of_two_writers_of_one_version_one_stands(spark):
    base = new_run_dir(spark, "t-publish")
    first = pub.publish(spark, base, writer(numbers(spark, 1)))

    def slow(path):
        other = spark.createDataFrame([(2, "000000000000", {"t": 0})], pub.COMMIT_SCHEMA)
        other.coalesce(1).write.json(f"{base}/commits/000000000002-other")
        return {}

    with pytest.raises(pub.ConcurrentPublish):
        pub.publish(spark, base, slow)
    assert [c.id for c in pub.commits(spark, base)] == [first.id, "000000000000"]


# --- quarantine

def test_quarantine_keeps_every_row(spark):
    base = new_run_dir(spark, "t-quarantine")
    db = "climastar_t_" + base.rsplit("-", 1)[1]
    contracts.reset_tables(spark, ["city_surface_temps", "cities_demog"], base, db)
    rows = spark.createDataFrame([(2000, 1, 1.5, "a"), (2000, 2, None, "b"), (2000, 3, 2.0, "c" * 257), (None, None, None, "d" * 300), (2000, 1, 1.5, "a")],
                                 "year int, mon int, average_temperature double, city string")
    done = quarantine_load(spark, rows, "city_surface_temps", db)
    assert (done.rows, done.accepted, done.rejected) == (5, 2, 3)
    assert sorted(r.city for r in spark.table(f"{db}.city_surface_temps").collect()) == ["a", "a"]
    bad = {r.city[0]: list(r.violations) for r in spark.table(f"{db}.city_surface_temps_rejected").collect()}
    assert bad == {"b": ["average_temperature: not null"], "c": ["city: at most 256 characters"],
                   "d": ["average_temperature: not null", "city: at most 256 characters"]}
    again = quarantine_load(spark, rows.where("city = 'b'"), "city_surface_temps", db)      # rejected rows only, and appended
    assert (again.accepted, again.rejected) == (0, 1) and spark.table(f"{db}.city_surface_temps_rejected").count() == 4
    none = quarantine_load(spark, rows.where("false"), "cities_demog", db)
    assert (none.rows, none.rejected) == (0, 0) and spark.table(f"{db}.cities_demog_rejected").count() == 0


# --- malformed records

def test_damaged_csv_lines_come_out_with_their_text(spark):
    path = new_run_dir(spark, "t-csv")
    write_text(path, "a.csv", 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x, y",,z\n\n,,\n')
    got = read_csv_checked(spark, path, ["a", "b", "c"])
    assert sorted(map(str, (tuple(r) for r in got.records.collect()))) == sorted(map(str, [("1", "2", "3"), ("x, y", None, "z"), (None, None, None)]))
    assert got.counts() == (5, 2)
    assert sorted(r.malformed for r in got.damaged.collect()) == ["4,5", "6,7,8,9"]


def test_damaged_json_lines_come_out_with_their_text(spark):
    path = new_run_dir(spark, "t-json")
    write_text(path, "a.json", '{"city":"A","Median Age":3}\n{"city":"B"\nnot json\n\n{"State":"C"}\n[1]\n')
    got = read_demographics_checked(spark, path)
    assert sorted((str(r.city), str(r.state), str(r.median_age)) for r in got.records.collect()) == [("A", "None", "3"), ("None", "C", "None")]
    assert got.counts() == (5, 3)
    assert sorted(r.malformed for r in got.damaged.collect()) == ["[1]", "not json", '{"city":"B"']


# --- content and files

def test_content_check_finds_one_changed_value(spark):
    path = new_run_dir(spark, "t-content")
    df = spark.createDataFrame([(i, f"s{i}", None if i % 3 else i / 7) for i in range(50)] + [(1, "s1", None)], "a int, b string, c double")
    receipt = write_parquet_receipt(df.repartition(5), path)
    assert receipt.rows == 51

    def passed(rows):
        return content_match("t", receipt, rows).first().passed

    stored = spark.read.schema(df.schema).parquet(path)
    assert passed(stored) and passed(stored.orderBy("b").repartition(2))
    assert not passed(stored.withColumn("b", F.when(F.col("a") == 7, "s8").otherwise(F.col("b"))))
    assert not passed(stored.withColumn("c", F.when(F.col("a") == 3, None).otherwise(F.col("c"))))
    assert not passed(stored.distinct())
    swapped = stored.where("a <> 1").union(spark.createDataFrame([(2, "s2", None), (2, "s2", None)], df.schema))
    assert swapped.count() == 51 and not passed(swapped)                         # a pair of repeats in place of another
    assert content_match("e", write_parquet_receipt(df.where("false"), path + "-e"), stored.where("false")).first().passed


def test_audit_names_the_damaged_file(spark):
    path = new_run_dir(spark, "t-audit") + "/a b"
    df = spark.range(4000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    df.repartition(5).write.parquet(path)
    manifest = spark.createDataFrame(file_manifest(spark, path, df.schema).collect(), "file string, bytes long, rows long, digest string")
    assert manifest.count() == 5 and manifest.agg(F.sum("rows")).first()[0] == 4000 and manifest.where("digest is null").count() == 0
    files = sorted(glob.glob(local(path) + "/part-*.parquet"))
    with open(files[0], "r+b") as f:
        f.truncate(os.path.getsize(files[0]) // 2)
    data = bytearray(open(files[1], "rb").read())
    data[200:260] = bytes(60)                                                     # values, not the footer
    open(files[1], "wb").write(data)
    os.rename(files[2], local(path) + "/renamed.parquet")
    for c in glob.glob(local(path) + "/.part-*.crc"):
        os.remove(c)
    found = {r.file: r for r in audit_files(manifest, file_manifest(spark, path, df.schema)).collect()}
    name = [os.path.basename(f) for f in files]
    assert {f: r.status for f, r in found.items()} == {name[0]: "damaged", name[1]: "damaged", name[2]: "missing", "renamed.parquet": "added",
                                                       name[3]: "ok", name[4]: "ok"}
    assert found[name[0]].rows is None and found[name[3]].rows == found[name[3]].rows_expected > 0


# --- incremental rebuild

TEMPERATURES = ("year int, mon int, average_temperature double, average_temperature_uncertainty double, city string, country string, "
                "latitude decimal(9,2), longitude decimal(9,2)")
AIRPORTS = ("ident string, type string, airport_name string, elevation_ft int, continent string, iso_country string, iso_region string, "
            "municipality string, gps_code string, iata_code string, local_code string, latitude double, longitude double")
DEMOGRAPHICS = ("city string, state string, median_age double, male_population int, female_population int, total_population int, "
                "veteran_population int, foreign_born int, ave_household_size double, state_code string, race string, count int")


@pytest.fixture
def parts(spark):
    t = [(y, m, (y or 0) + m / 10, 0.1, c, "US", None, None) for y in (1999, 2000, 2001, None) for m in (1, 2) for c in ("A", "B")]
    a = [(f"K{i}", "small", f"n{i}", i, "NA", "US", "US-X", c, None, None, None, 1.0 * i, 2.0) for i, c in enumerate("AAB")]
    d = [(c, "S", 30.0, 1, 2, 3, 4, 5, 2.5, "ST", r, 9) for c in "AB" for r in ("x", "y")]
    return (spark.createDataFrame(t, TEMPERATURES), spark.createDataFrame(a, AIRPORTS), spark.createDataFrame(d, DEMOGRAPHICS))


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def written_files(base):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(local(base) + "/fact_table/year=*/*.parquet")}


def test_a_rebuild_of_many_years_reads_each_input_once(spark, parts):
    counters = [spark.sparkContext.accumulator(0) for _ in parts]

    def counted(df, acc):
        def pass_on(batches):
            for b in batches:
                acc.add(b.num_rows)
                yield b
        return df.mapInArrow(pass_on, df.schema)

    base = new_run_dir(spark, "t-incremental")
    done = rebuild_fact(FactSource(*map(counted, parts, counters), "stable"), base)
    assert done.rewritten == [None, 1999, 2000, 2001] and done.rows_written == 4 * 2 * 3
    assert [acc.value for acc in counters] == [df.count() for df in parts]
    assert rows_of(read_fact(spark, base)) == rows_of(build_fact(*parts))


def test_only_the_changed_year_is_rewritten(spark, parts):
    t, a, d = parts
    base = new_run_dir(spark, "t-incremental")
    first = rebuild_fact(FactSource(t, a, d, "stable"), base)
    assert first.rewritten == [None, 1999, 2000, 2001] and first.rows_written == 4 * 2 * 3
    assert rows_of(read_fact(spark, base)) == rows_of(build_fact(t, a, d))
    before = written_files(base)

    same = rebuild_fact(FactSource(t.repartition(3).union(t.limit(2)), a, d, "stable"), base)       # other order, repeated rows
    assert (same.rewritten, same.removed, written_files(base)) == ([], [], before)

    t2 = t.withColumn("average_temperature", F.when((F.col("year") == 2000) & (F.col("mon") == 2), 7.25).otherwise(F.col("average_temperature")))
    second = rebuild_fact(FactSource(t2, a, d, "stable"), base)
    assert second.rewritten == [2000]
    assert rows_of(read_fact(spark, base)) == rows_of(build_fact(t2, a, d))
    after = written_files(base)
    assert {f for f in before if "year=2000" not in f} == {f for f in after if "year=2000" not in f}
    assert all(before[f] == after[f] for f in before if "year=2000" not in f) and not {f for f in before if "year=2000" in f} & set(after)


def test_new_removed_and_null_years_and_changed_airports(spark, parts):
    t, a, d = parts
    base = new_run_dir(spark, "t-incremental")
    rebuild_fact(FactSource(t.where("year is not null"), a, d, "stable"), base)
    done = rebuild_fact(FactSource(t.where("year is null or year <> 1999"), a, d, "stable"), base)
    assert (done.rewritten, done.removed) == ([None], [1999])
    assert rows_of(read_fact(spark, base)) == rows_of(build_fact(t.where("year is null or year <> 1999"), a, d))
    other = a.withColumn("type", F.lit("large"))
    assert rebuild_fact(FactSource(t, other, d, "stable"), base).rewritten == [None, 1999, 2000, 2001]
    assert rows_of(read_fact(spark, base)) == rows_of(build_fact(t, other, d))
    gone = rebuild_fact(FactSource(t.where("false"), other, d, "stable"), base)
    assert gone.rewritten == [] and len(gone.removed) == 4 and read_fact(spark, base).count() == 0


def test_a_rebuild_killed_before_its_digests_is_repeated(spark, parts, monkeypatch):
    from climastar.plans import incremental

    t, a, d = parts
    base = new_run_dir(spark, "t-incremental")
    rebuild_fact(FactSource(t, a, d, "stable"), base)
    t2 = t.withColumn("average_temperature_uncertainty", F.when(F.col("year") == 2001, 9.0).otherwise(0.1))

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(incremental, "publish", killed)
        with pytest.raises(RuntimeError, match="killed"):
            rebuild_fact(FactSource(t2, a, d, "stable"), base)
    assert rebuild_fact(FactSource(t2, a, d, "stable"), base).rewritten == [2001]
    assert rows_of(read_fact(spark, base)) == rows_of(build_fact(t2, a, d))


# --- layouts, joint adjustment

def test_colocated_reports_need_no_exchange(spark, parts):
    model = build_model(*parts)
    base = new_run_dir(spark, "t-colocated")
    db = "climastar_t_" + base.rsplit("-", 1)[1]
    write_colocated(spark, model, base, db, 4)
    write_colocated(spark, model, base, db, 4)                                     # replaces
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for report in (report_city_climate, report_city_veterans):
            got = report(read_colocated(spark, db))
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
            assert rows_of(got) == rows_of(report(model)) and got.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert (bucket_count(0, 1), bucket_count(5_000_001, 1), bucket_count(10, 5)) == (1, 2, 8)


def test_colocated_fact_is_written_from_the_join(spark, parts, monkeypatch):
    from climastar.plans import colocated

    model = build_model(*parts)
    fact = colocated_fact(model.source, 4)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("Exchange")                             # parts are shuffled, fact rows are not
    assert rows_of(fact) == rows_of(model.fact) and fact.rdd.getNumPartitions() == 4
    base = new_run_dir(spark, "t-colocated")
    db = "climastar_t_" + base.rsplit("-", 1)[1]
    was = spark.conf.get(colocated._WRITERS)
    write_colocated(spark, model, base, db, 4)
    assert spark.conf.get(colocated._WRITERS) == was
    files = [f.rsplit("_", 1)[1][:5] for f in glob.glob(f"{local(base)}/{db}.db/fact_table/part-*.parquet")]
    assert files and len(files) == len(set(files))                                 # a file for a bucket
    stored = read_colocated(spark, db).fact
    assert rows_of(stored) == rows_of(model.fact) and set(f.name for f in stored.schema) == set(model.fact.columns)


def test_a_city_with_most_rows_is_written_into_its_bucket_by_several_tasks(spark, parts, monkeypatch):
    from climastar.operators import joins

    temperatures, airports, demographics = parts
    city = temperatures.where("city is not null").first().city
    more = spark.range(600).select(*[(F.col("id").cast("double") if f.name == "average_temperature" else F.lit(city if f.name == "city" else None))
                                     .cast(f.dataType).alias(f.name) for f in temperatures.schema])
    model = build_model(temperatures.union(more), airports, demographics)
    monkeypatch.setattr(joins, "ROWS_PER_CELL", 10)
    fact = colocated_fact(model.source, 8)
    tasks = [r["count"] for r in fact.where(F.col("city") == city).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(tasks) >= 600 and max(tasks) <= sum(tasks) / 2
    base = new_run_dir(spark, "t-colocated")
    db = "climastar_t_" + base.rsplit("-", 1)[1]
    write_colocated(spark, model, base, db, 8)
    stored = read_colocated(spark, db)
    assert rows_of(stored.fact) == rows_of(model.fact)
    assert rows_of(report_city_climate(stored)) == rows_of(report_city_climate(model))


def test_mean_of_a_large_fact_in_one_task_keeps_its_digits(spark):
    value = F.when(F.col("id") >= 0, 250000.1)
    fact = spark.range(0, 3_000_000, 1, 1).select(F.lit("X").alias("city"), value.alias("average_temperature"))
    fact = fact.union(spark.createDataFrame([("X", None), ("Y", None)], fact.schema))
    assert rows_of(city_mean_temperature(StarModel(fact, None, None))) == rows_of(spark.createDataFrame([("X", 250000.1), ("Y", None)], fact.schema))


def test_clustered_files_hold_few_keys(spark):
    path = new_run_dir(spark, "t-clustered")
    df = spark.range(20000).select((F.col("id") % 10).cast("string").alias("city"), (F.col("id") % 7).cast("int").alias("year"), "id")
    write_parquet_overwrite(clustered(df, ["city", "year"], 16), path)
    spans = []
    for f in glob.glob(local(path) + "/part-*.parquet"):
        meta = pq.ParquetFile(f).metadata
        spans += [(meta.row_group(i).column(0).statistics.min, meta.row_group(i).column(0).statistics.max) for i in range(meta.num_row_groups)]
    assert len(spans) >= 10 and all(sum(lo <= str(c) <= hi for lo, hi in spans) <= 4 for c in range(10))
    assert spark.read.parquet(path).where("city = '3' and year = 2").count() == df.where("city = '3' and year = 2").count()
    hot = df.withColumn("city", F.lit("one"))                                     # one key: spread over the files all the same
    write_parquet_overwrite(clustered(hot, ["city"], 8), path + "-hot")
    assert len(glob.glob(local(path) + "-hot/part-*.parquet")) > 4


@pytest.mark.parametrize("latitudes,plane", [((5.0, 1.0, 2.0, 9.0), True), ((10.0, 20.0, 30.0, 40.0), False)])
def test_joint_adjustment(spark, latitudes, plane):
    cities = [("A", 100, latitudes[0]), ("B", 200, latitudes[1]), ("C", 300, latitudes[2]), ("D", 400, latitudes[3])]
    fact = spark.createDataFrame([(c, 20.0 - 0.01 * e + 2 * lat) for c, e, lat in cities], "city string, average_temperature double")
    air = spark.createDataFrame([(c, e, lat) for c, e, lat in cities], "municipality string, elevation_ft int, latitude double")
    demo = spark.createDataFrame([(c,) for c, _, _ in cities], "city string")
    rows = adjust_joint(StarModel(fact, air, demo)).collect()
    assert len(rows) == 4
    for r in rows:
        assert ((r.elevation_slope, r.latitude_slope, r.residual) == (-0.01, 2.0, 0.0)) if plane else (r.elevation_slope is r.residual is None)


def test_certainty_of_the_stronger_influence(spark):
    """Temperature follows the airports, not the population: the interval of the difference says so, and the same on every run."""
    rows = [(f"c{i}", i % 9 + 1, (i * 7919) % 101) for i in range(60)]
    fact = spark.createDataFrame([(c, 3.0 * a + p % 3 / 10) for c, a, p in rows], "city string, average_temperature double")
    air = spark.createDataFrame([(c, f"n{k}") for c, a, _ in rows for k in range(a)], "municipality string, airport_name string")
    demo = spark.createDataFrame([(c, "S", "r", p) for c, _, p in rows], "city string, state string, race string, total_population int")
    runs = [{r.measure: r for r in influence_certainty(StarModel(f, air, demo), 50).collect()} for f in (fact, fact.repartition(7))]
    assert runs[0] == runs[1]
    got = runs[0]
    assert got["airports"].low > 0.99 and got["airports less population"].low > 0.4 and got["population"].replicates == 50
    flat = StarModel(fact.withColumn("average_temperature", F.lit(1.0)), air, demo)
    assert influence_certainty(flat, 5).count() == 0
    assert abs(poisson_steps()[1] - 2 / 2.718281828459045) < 1e-12 and poisson_steps()[-1] > 1 - 1e-8


def test_year_without_fact_rows_left_is_emptied(spark):
    """A city's airports move away: its year keeps its temperatures, but no fact row."""
    from climastar.plans.catalog import clean_inputs
    from climastar.plans.incremental import read_fact, rebuild_fact
    from climastar.plans.model import FactSource

    c = clean_inputs(spark, SF0001)
    base = new_run_dir(spark, "t-emptied")
    t = c.temperatures.where("year = 1997 OR year = 1998")
    src = lambda airports: FactSource(t, airports, c.demographics, "stable")          # noqa: E731
    rebuild_fact(src(c.airports), base)
    assert read_fact(spark, base).count() > 0
    done = rebuild_fact(src(c.airports.withColumn("municipality", F.lit("elsewhere"))), base)
    assert done.rewritten == [1997, 1998] and done.rows_written == 0 and read_fact(spark, base).count() == 0


def test_clustered_fact_shuffles_no_fact_row(spark, monkeypatch):
    """The fact ranged before the fan-out: the same rows, and nothing but the ranged temperatures is exchanged above the parts."""
    import climastar.plans.model as M
    from climastar.plans.catalog import model

    m = model(spark, SF0001)
    got = M.clustered_fact(m.source, ["city", "year"], 4)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("RepartitionByExpression")
    want = m.fact.select("id")
    assert got.count() == want.count() and got.select("id").exceptAll(want).count() == 0
    parts = got.select(F.spark_partition_id().alias("p"), "city", "year").distinct().groupBy("p").count().collect()
    assert len(parts) > 1
    monkeypatch.setattr(M, "BROADCAST_ROWS", 0)
    assert M.clustered_fact(m.source, ["city", "year"], 4).select("id").exceptAll(want).count() == 0


def test_keys_take_little_more_than_their_bits(spark, tmp_path):
    """32 hexadecimal characters hold 16 bytes, and little more than that is stored."""
    rows = spark.range(50_000, numPartitions=1).select(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 32).alias("id"))
    write_parquet_overwrite(rows, f"{tmp_path}/keys")
    assert sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/keys/*.parquet")) < 50_000 * 22
