import math

import pytest
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import quality as Q

DAY = "2020-01-01"


def record(spark, **values):
    names = {f.name: None for f in S.WEATHER}
    names.update(station_id=1, station_name="X", latitude=51.5, longitude=-0.13, **values)
    row = tuple(names[n] for n in S.WEATHER_COLUMNS if n != "date")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.WEATHER if f.name != "date")
    df = spark.createDataFrame([row], kinds)
    df = df.withColumn("date", F.to_date(F.lit(DAY)))
    return df if any(c in values for c in S.VALIDATION_COLUMNS) else Q.with_physical_validity(df)


def value(df, column):
    return df.select(column.alias("y")).first().y


@pytest.mark.parametrize(
    "lo, hi, mid, grade",
    [
        (10.0, 20.0, 15.0, "Valid"),
        (None, None, None, None),
        (-40.0, 70.0, None, "Suspect"),  # the first bad value decides
        (10.0, 70.0, None, "Invalid"),
        (None, None, 46.0, "Suspect"),
        (-90.1, None, None, "Invalid"),
        (-90.0, None, None, "Suspect"),
        (60.0, None, None, "Suspect"),
        (45.0, -35.0, None, "Valid"),
        (math.nan, None, None, "Invalid"),
    ],
)
def test_temperature_validity(spark, lo, hi, mid, grade):
    df = record(spark, temp_min=lo, temp_max=hi, temp_avg=mid)
    assert df.first().temp_validation == grade


@pytest.mark.parametrize(
    "rain, wind, rain_grade, wind_grade",
    [
        (0.0, 0.0, "Valid", "Valid"),
        (500.0, 50.0, "Valid", "Valid"),
        (500.1, 50.1, "Suspect", "Suspect"),
        (2000.0, 120.0, "Suspect", "Suspect"),
        (2000.1, 120.1, "Invalid", "Invalid"),
        (-0.1, -0.1, "Invalid", "Invalid"),
        (math.nan, math.nan, "Invalid", "Invalid"),
        (None, None, None, None),
    ],
)
def test_amount_validity(spark, rain, wind, rain_grade, wind_grade):
    row = record(spark, precipitation=rain, wind_speed=wind).first()
    assert (row.precip_validation, row.wind_validation) == (rain_grade, wind_grade)


@pytest.mark.parametrize(
    "flags, validity, expected",
    [
        ("9", "Invalid", "Missing"),
        ("0", "Invalid", "Invalid"),
        ("1", "Invalid", "Invalid"),
        ("1", "Suspect", "SuspectBoth"),
        ("1", "Valid", "SuspectOriginal"),
        ("0", "Suspect", "SuspectRange"),
        ("0", "Valid", "Valid"),
        (None, None, "Valid"),
        (None, "Suspect", "SuspectRange"),
    ],
)
def test_combined_quality(spark, flags, validity, expected):
    df = record(
        spark,
        temp_quality=flags and f"0{flags}",
        precip_quality=flags,
        wind_quality=flags,
        temp_validation=validity,
        precip_validation=validity,
        wind_validation=validity,
    )
    for column in (Q.temperature_quality(), Q.precipitation_quality(), Q.wind_quality()):
        assert value(df, column) == expected
    assert value(df, Q.has_invalid_data()) is (expected == "Invalid")
    assert value(df, Q.has_high_quality_data()) is (validity is None or expected == "Valid")


def test_amount_flags_are_compared_whole(spark):
    df = record(spark, precip_quality="19", wind_quality="90", precip_validation="Valid", wind_validation="Valid")
    assert value(df, Q.precipitation_quality()) == "Valid"
    assert value(df, Q.wind_quality()) == "Valid"


def test_full_and_partial_records(spark):
    full = record(spark, temp_min=10.0, temp_max=20.0, temp_avg=15.0, precipitation=5.5, wind_speed=3.0)
    assert value(full, Q.available_metrics()) == ["temperature", "precipitation", "wind_speed"]
    assert value(full, Q.metric_coverage()) == 1.0
    assert value(full, Q.temperature_range()) == 10.0
    partial = record(spark, temp_min=10.0, precipitation=5.5)
    assert value(partial, Q.available_metrics()) == ["temperature", "precipitation"]
    assert abs(value(partial, Q.metric_coverage()) - 2 / 3) < 1e-6
    assert value(partial, Q.has_complete_temperature()) is False
    assert value(partial, Q.temperature_range()) is None


def test_flags(spark):
    df = record(spark, temp_quality="001", precip_quality="0")
    assert value(df, Q.has_suspect_flag()) is True
    assert value(df, Q.has_missing_flag()) is False
    assert value(df, Q.temperature_flag_valid()) is False
    assert value(df, Q.precipitation_flag_valid()) is True
    assert value(df, Q.wind_flag_valid()) is False


@pytest.mark.parametrize(
    "values, broken",
    [
        (dict(temp_min=20.0, temp_avg=15.0, temp_max=10.0), "MinGreaterThanAvg"),
        (dict(temp_min=10.0, temp_avg=15.0, temp_max=10.0), "AvgGreaterThanMax"),
        (dict(temp_min=16.0, temp_avg=15.0, temp_max=14.0), None),  # inside the tolerance
        (dict(temp_avg=15.0, temp_max=10.0), None),  # an incomplete triple is not compared
        (dict(temp_max=55.0), "OutOfRange"),
        (dict(precipitation=1500.0), "OutOfRange"),
        (dict(wind_speed=110.0), "OutOfRange"),
        (dict(temp_min=10.0, temp_avg=15.0, temp_max=20.0, precipitation=5.0), None),
    ],
)
def test_violations(spark, values, broken):
    assert value(record(spark, **values), Q.record_violation()) == broken


def test_narrow_triple_check(spark):
    df = spark.createDataFrame([(10.0, 15.0, 20.0), (10.0, 25.0, 20.0), (15.2, 15.0, 20.0)], "a float, b float, c float")
    got = [r.y for r in df.select(Q.triple_violation(F.col("a"), F.col("b"), F.col("c")).alias("y")).collect()]
    assert got == [None, "AvgGreaterThanMax", "MinGreaterThanAvg"]


@pytest.mark.parametrize("flag, legal, usable, strict", [(0, True, True, True), (1, True, True, False), (9, True, False, False), (5, False, False, False)])
def test_flag_rules(spark, flag, legal, usable, strict):
    df = spark.createDataFrame([(flag,)], "q int")
    q = F.col("q")
    assert tuple(df.select(Q.flag_is_legal(q), Q.flag_is_usable(q), Q.flag_is_strict(q)).first()) == (legal, usable, strict)
