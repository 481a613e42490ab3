"""Scalar expressions on the hand-written edge rows (no driver table has
NULLs, malformed text or short splits)."""

from decimal import Decimal

from climastar.functions import (
    date_month, date_year, hemisphere_coordinate, split_part, stable_key, to_double, to_int,
)
from climastar.functions.parsing import hemisphere_coordinate_udf


def test_hemisphere(spark):
    rows = [("45.81N",), ("45.81S",), ("123.46W",), ("2.45E",), (None,), ("bad",), ("",)]
    df = spark.createDataFrame(rows, "c string")
    got = [r.v for r in df.select(hemisphere_coordinate("c").alias("v")).collect()]
    assert got == [Decimal("45.81"), Decimal("-45.81"), Decimal("-123.46"), Decimal("2.45"),
                   None, None, None]


def test_hemisphere_native_equals_udf(spark):
    rows = [("45.81N",), ("45.81S",), ("123.46W",), ("2.45E",), (None,), ("bad",), ("",),
            ("0.01S",), ("179.99E",)]
    df = spark.createDataFrame(rows, "c string")
    out = df.select(hemisphere_coordinate("c").alias("a"), hemisphere_coordinate_udf("c").alias("b"))
    assert all(r.a == r.b for r in out.collect())


def test_split_coordinates(spark):
    df = spark.createDataFrame([("-122.5, 45.5",), ("x",), (None,)], "c string")
    out = df.select(to_double(split_part("c", ", ", 1)).alias("lat"),
                    to_double(split_part("c", ", ", 0)).alias("lon")).collect()
    assert [(r.lat, r.lon) for r in out] == [(45.5, -122.5), (None, None), (None, None)]


def test_text_to_int(spark):
    vals = ["12.7", "-12.7", "", "abc", " 7 ", "NaN", "99999999999", "12d", "12f", "-0.9"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [r.i for r in df.select(to_int("c").alias("i")).collect()]
    assert got == [12, -12, None, None, 7, None, None, None, None, 0]


def test_large_integers_are_exact(spark):
    from climastar.functions import to_long

    vals = ["9007199254740993", "9223372036854775807", "-9223372036854775808", "9223372036854775808", "9007199254740993.9"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    assert [r.i for r in df.select(to_long("c").alias("i")).collect()] == [
        9007199254740993, 9223372036854775807, -9223372036854775808, None, 9007199254740993]
    whole = spark.createDataFrame([(9007199254740993,)], "c bigint")
    assert whole.select(to_long("c").alias("i")).first().i == 9007199254740993


def test_date_parts(spark):
    df = spark.createDataFrame([("1849-03-01",), ("1849",)], "d string")
    got = [(r.y, r.m) for r in df.select(date_year("d").alias("y"), date_month("d").alias("m")).collect()]
    assert got == [(1849, 3), (1849, None)]


def test_measure_kept_only_when_numeric(spark):
    from climastar.plans.clean import clean_temperatures

    rows = [("2000-01-01", v, "0.1", "Portland", "United States", "45.5N", "122.6W")
            for v in ["1.5", "", "NaN", "abc"]]
    raw = spark.createDataFrame(rows, "dt string, AverageTemperature string, "
                                "AverageTemperatureUncertainty string, City string, Country string, "
                                "Latitude string, Longitude string")
    out = clean_temperatures(raw).collect()
    assert [r.average_temperature for r in out] == [1.5]
    assert out[0].latitude == Decimal("45.50") and out[0].longitude == Decimal("-122.60")


def test_stable_key_null_and_empty_differ(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("x", None)], "a string, b string")
    ids = [r.id for r in df.select(stable_key(df, ["a", "b"]).alias("id")).collect()]
    assert len(set(ids)) == 3


def test_stable_key_tells_all_rows_apart(spark):
    inf = float("inf")
    rows = [(10.0000001, "a", "b"), (10.0000002, "a", "b"), (float("nan"), "a", "b"), (None, "a", "b"), (inf, "a", "b"), (-inf, "a", "b"),
            (1e13, "a", "b"), (2e13, "a", "b"), (0.0, "a|b", "c"), (0.0, "a", "b|c"), (0.0, "\\N", "c"), (0.0, None, "c"),
            (0.0, "-", "c"), (0.0, "1:a", ""), (0.0, "", "1:a")]
    df = spark.createDataFrame(rows, "x double, y string, z string")
    assert df.select(stable_key(df, ["x", "y", "z"]).alias("id")).distinct().count() == len(rows)
    zero = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert zero.select(stable_key(zero, ["x"]).alias("id")).distinct().count() == 1
