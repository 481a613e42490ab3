"""Model semantics on hand-written edge rows (FIXTURES §4)."""

import pytest
from climastar.operators.quality import EmptySourceError
from climastar.plans.clean import clean_all, clean_demographics
from climastar.plans.model import FACT_COLUMNS, build_model
from climastar.plans.reports import report_city_climate

TEMP_SCHEMA = ("dt string, AverageTemperature string, AverageTemperatureUncertainty string, "
               "City string, Country string, Latitude string, Longitude string")
AIR_SCHEMA = ("ident string, type string, name string, elevation_ft string, continent string, "
              "iso_country string, iso_region string, municipality string, gps_code string, "
              "iata_code string, local_code string, coordinates string")
DEMO_SCHEMA = ("city string, state string, median_age string, male_population string, "
               "female_population string, total_population string, number_of_veterans string, "
               "foreign_born string, average_household_size string, state_code string, "
               "race string, count string")


def temps(spark, rows):
    return spark.createDataFrame(rows, TEMP_SCHEMA)


def airports(spark, rows):
    return spark.createDataFrame(rows, AIR_SCHEMA)


def demographics(spark, rows):
    return spark.createDataFrame(rows, DEMO_SCHEMA)


def airport(ident, name, city, country="US", coords="-122.6, 45.5"):
    return (ident, "small_airport", name, "30", "NA", country, "US-OR", city, ident, None, ident, coords)


def demo(city, state, pop, race="White", count="10", veterans="5"):
    return (city, state, "35.5", "100", "110", pop, veterans, "20", "2.5", state[:2].upper(), race, count)


def t(city, value, month="01"):
    return (f"2000-{month}-01", value, "0.2", city, "United States", "45.5N", "122.6W")


@pytest.fixture()
def edge_model(spark):
    T = temps(spark, [t("Portland", "10.0", "01"), t("Portland", "12.0", "02"),
                      t("Portland", "12.0", "02"),                 # duplicate month row
                      t("portland", "99.0"), t("Portland ", "99.0"), t(None, "99.0")])
    A = airports(spark, [airport("P1", "PDX", "Portland"), airport("P1", "PDX", "Portland"),
                         airport("P2", "PDX", "Portland"), airport("P3", None, "Portland"),
                         airport("X1", "XXX", "Portland", country="us"),
                         airport("X2", "YYY", "Portland", country=None)])
    D = demographics(spark, [demo("Portland", "Oregon", "650000"),
                             demo("Portland", "Maine", "66000"),
                             demo("Portland", "Oregon", "650000", race="Asian", count="3")])
    c = clean_all(T, A, D)
    return c, build_model(c.temperatures, c.airports, c.demographics)


def test_country_code_filter_is_exact(edge_model):
    c, _ = edge_model
    assert sorted(r.ident for r in c.airports.collect()) == ["P1", "P1", "P2", "P3"]


def test_continent_na_is_text(edge_model):
    c, _ = edge_model
    assert {r.continent for r in c.airports.collect()} == {"NA"}


def test_fact_distinct_and_keyed(edge_model):
    _, m = edge_model
    fact = m.fact
    n = fact.count()
    assert fact.select(*FACT_COLUMNS).distinct().count() == n
    assert fact.select("id").distinct().count() == n
    # keys compare exactly: 'portland', 'Portland ' and NULL do not join
    assert {r.city for r in fact.select("city").distinct().collect()} == {"Portland"}
    # 2 distinct temperature rows x 3 distinct airports parts x 3 demographics parts
    assert n == 2 * 3 * 3


def test_report_first_is_least_state_race(edge_model):
    _, m = edge_model
    r = report_city_climate(m).collect()
    assert len(r) == 1
    row = r[0]
    assert row.city == "Portland"
    assert row.total_population == 66000          # ('Maine', 'White') is least
    assert row.total_airports == 1                # PDX twice, NULL name not counted
    assert row.average_temperature == pytest.approx(11.0)


def test_dimension_dedup(edge_model):
    _, m = edge_model
    assert m.dim_airport.count() == 2             # P1/P2 share a dimension row; NULL name
    assert m.dim_demographics.count() == 3


def test_empty_source_raises(spark):
    T = temps(spark, [t("Portland", "abc")])      # no usable measure
    A = airports(spark, [airport("P1", "PDX", "Portland")])
    D = demographics(spark, [demo("Portland", "Oregon", "1")])
    with pytest.raises(EmptySourceError):
        clean_all(T, A, D)


def test_title_case_demographics(spark):
    raw = spark.createDataFrame([("Portland", "Oregon", "35.5", "7")],
                                "city string, state string, `Median Age` string, number_of_veterans string")
    d = clean_demographics(raw).collect()[0]
    assert d.median_age == 35.5 and d.veteran_population == 7 and d["count"] is None


def test_input_without_join_key_raises(spark):
    T = temps(spark, [t("Portland", "1.0")])
    A = airports(spark, [airport("P1", "PDX", "Portland")])
    D = demographics(spark, [demo(None, "Oregon", "1")])
    with pytest.raises(EmptySourceError, match="demographics"):
        clean_all(T, A, D)


def test_declared_schemas_match_built_tables(spark):
    from climastar.plans.catalog import model
    from climastar.plans.model import table_schema
    from conftest import SF0001

    m = model(spark, SF0001)
    for name, df in m.tables().items():
        got = [(f.name, f.dataType) for f in df.schema.fields]
        want = [(f.name, f.dataType) for f in table_schema(name).fields]
        assert got == want, name
