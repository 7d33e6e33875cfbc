"""Coordinates and text helpers."""

from pyspark.sql import functions as F

from fleetzone.functions.coords import lat_dd, lon_dd
from fleetzone.functions.text import clean_column_names, clean_name, first_part, label, year_text


def test_hemisphere_signs(spark):
    rows = [(40.0, 30.0, "N", 67.0, 30.0, "W"), (40.0, 30.0, "S", 67.0, 30.0, "E"),
            (40.0, 30.0, None, 67.0, 30.0, None)]
    df = spark.createDataFrame(rows, "ld double, lm double, lh string, od double, om double, oh string")
    got = [(r.a, r.o) for r in df.select(lat_dd("ld", "lm", "lh").alias("a"),
                                         lon_dd("od", "om", "oh").alias("o")).collect()]
    assert got == [(40.5, -67.5), (-40.5, 67.5), (40.5, -67.5)]


def test_minutes_not_degrees_in_every_position(spark):
    # the slip "degrees / 60" must not come back: 40 deg 30 min is 40.5
    df = spark.createDataFrame([(40.0, 30.0)], "d double, m double")
    assert df.select(lat_dd("d", "m", F.lit("N")).alias("v")).first().v == 40.5


def test_year_text_label_first_part(spark):
    df = spark.createDataFrame([("2018-10-09", "A", 3), (None, None, None)], "d string, t string, h int")
    got = df.select(year_text("d").alias("y"), label(F.col("t"), ".", F.col("h")).alias("k"),
                    first_part(label(F.col("t"), ".", F.col("h")), ".").alias("f")).collect()
    assert [tuple(r) for r in got] == [("2018", "A.3", "A"), (None, "NA.NA", "NA")]


def test_clean_names():
    assert clean_name("coast guard nbr") == "COAST_GUARD_NBR"
    assert clean_name("landing.year") == "LANDING_YEAR"
    assert clean_name("1st price") == "X1ST_PRICE"
    assert clean_name("na") == "NA_"
    assert clean_name("") == "X"


def test_clean_column_names_frame(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `C-d` int")
    assert clean_column_names(df).columns == ["A_B", "C_D"]
