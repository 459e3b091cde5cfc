import datetime

import pytest
from pyspark.sql import functions as F

from skyledger.functions import geo as G
from skyledger.functions import text as X
from skyledger.sources import ranges


def one(spark, value, f):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "text, degrees",
    [
        ("50:30:15", 50.504167),
        ("-0:07:39", -0.1275),
        ("-6:44:00", -6.733333),
        ("+014:48:00", 14.8),
        ("51:30:26", 51.507222),
        (" 53.5 ", 53.5),
        ("-6.25", -6.25),
        ("50:30", None),
        ("50:70:15", None),
        ("50:30:70", None),
        ("50:-1:00", None),
        ("1:2:3:4", None),
        ("abc", None),
        ("1:x:3", None),
    ],
)
def test_coordinates(spark, text, degrees):
    got = one(spark, text, X.to_degrees)
    assert got is None if degrees is None else abs(got - degrees) < 1e-6


@pytest.mark.parametrize("degrees, text", [(50.504167, "50:30:15.00"), (-6.7375, "-6:44:15.00"), (0.0, "0:00:00.00")])
def test_degrees_as_text(spark, degrees, text):
    df = spark.createDataFrame([(degrees,)], "x double")
    assert df.select(X.degrees_to_dms(F.col("x")).alias("y")).first().y == text


@pytest.mark.parametrize(
    "text, day",
    [
        ("19500101", datetime.date(1950, 1, 1)),
        ("1950011", datetime.date(1950, 1, 1)),
        ("19500230", None),
        ("1950-01-01", None),
        ("195001011", None),
        ("+9500101", None),
        ("", None),
        ("19500101\n", None),
    ],
)
def test_dates(spark, text, day):
    assert one(spark, text, X.to_date) == day


@pytest.mark.parametrize(
    "text, whole, number",
    [
        ("125", 125, 125.0),
        ("+125", 125, 125.0),
        ("-9", -9, -9.0),
        ("12.5", None, 12.5),
        ("1f", None, None),
        ("0x10", None, None),
        ("1e2", None, 100.0),
        (".5", None, 0.5),
        ("", None, None),
        ("99999999999", None, 99999999999.0),
    ],
)
def test_numbers(spark, text, whole, number):
    assert one(spark, text, X.to_int) == whole
    assert one(spark, text, lambda c: X.to_decimal(c, "double")) == number


NAMES = {
    "TX_STAID000257.txt": ("TX", 257),
    "RR_STAID001234.txt": ("RR", 1234),
    "invalid_file.txt": (None, None),
    "dir/TN_STAID000001.txt": (None, 1),
    "TN_STAID000000.txt": ("TN", None),
    "QQ_STAID000001.txt": (None, 1),
    "TG_STAID000001.csv": (None, 1),
    "FG_STAID12.v2.txt": ("FG", 12),
}


@pytest.mark.parametrize("name", NAMES)
def test_entry_names(spark, name):
    element, station = NAMES[name]
    assert one(spark, name, X.entry_prefix) == element
    assert one(spark, name, X.entry_station) == station
    in_task = ranges.data_entry(name, ["TN", "TX", "TG", "RR", "FG"])
    assert in_task == ((element, station) if element else None)


def test_strip_takes_unicode_blanks(spark):
    assert one(spark, " \t 12 \r\n", X.strip) == "12"
    assert one(spark, "12\n", X.is_plain) is False


def test_distance(spark):
    df = spark.createDataFrame([(51.5074, -0.1278, 55.9533, -3.1883)], "a double, b double, c double, d double")
    km = df.select(G.haversine_km(*map(F.col, "abcd")).alias("y")).first().y
    assert abs(km - 534) < 10


@pytest.mark.parametrize("lat, lon, inside", [(51.5, -0.13, True), (55.95, -3.19, True), (48.0, 0.0, False), (62.0, 0.0, False)])
def test_uk_box(spark, lat, lon, inside):
    df = spark.createDataFrame([(lat, lon)], "a double, b double")
    assert df.select(G.in_box(F.col("a"), F.col("b")).alias("y")).first().y is inside


@pytest.mark.parametrize("country, uk", [("GB", True), ("uk", True), ("United Kingdom", True), ("IE", False)])
def test_uk_country(spark, country, uk):
    assert one(spark, country, G.is_uk_country) is uk
