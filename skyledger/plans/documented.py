"""Queries users are told to run on the table of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import quality as Q

_VALIDATIONS = ("temp_validation", "precip_validation", "wind_validation")


def _all_valid(columns=_VALIDATIONS):
    test = F.lit(True)
    for c in columns:
        test = test & (F.col(c) == "Valid")
    return test


def station_history(records: DataFrame, station: int) -> DataFrame:
    return records.filter(F.col("station_id") == station).orderBy("date")


def newest_multi_metric(records: DataFrame, n: int = 100) -> DataFrame:
    """Newest rows with mean temperature, precipitation and wind; ties by station."""
    rows = records.dropna(subset=["temp_avg", "precipitation", "wind_speed"])
    return (
        rows.orderBy(F.desc("date"), "station_name", "station_id")
        .limit(n)
        .select("station_name", "date", "temp_avg", "precipitation", "wind_speed")
    )


def metric_quality_counts(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("temp_min").alias("temp_records"),
        F.count("precipitation").alias("precip_records"),
        F.count("wind_speed").alias("wind_records"),
        F.count_if(F.col("temp_validation") == "Invalid").alias("invalid_temp"),
    )


def extreme_events(records: DataFrame) -> DataFrame:
    """Hot, wet or windy days; a day without one of the three gradings does not qualify."""
    strong = (F.col("temp_max") > 35.0) | (F.col("precipitation") > 100.0) | (F.col("wind_speed") > 30.0)
    for c in _VALIDATIONS:
        strong = strong & (F.col(c) != "Invalid")
    return (
        records.filter(strong)
        .orderBy(F.desc("temp_max"), F.desc("precipitation"), F.desc("wind_speed"))
        .select("date", "station_name", "temp_max", "precipitation", "wind_speed")
    )


def _month():
    return F.trunc("date", "month")


def monthly_means(records: DataFrame, least: int = 20) -> DataFrame:
    return (
        records.filter(_all_valid(("temp_validation", "precip_validation")))
        .groupBy("station_id", "station_name", _month().alias("month"))
        .agg(
            F.avg("temp_avg").alias("monthly_temp"),
            F.avg("precipitation").alias("monthly_precip"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .filter(F.col("record_count") >= least)
        .orderBy("station_id", "month")
    )


def complete_temperature_stations(records: DataFrame) -> DataFrame:
    return (
        records.filter(Q.has_complete_temperature())
        .groupBy("station_id", "station_name")
        .agg(F.count(F.lit(1)).alias("record_count"))
    )


def monthly_temperature_and_rain(records: DataFrame) -> DataFrame:
    return (
        records.dropna(subset=["temp_avg", "precipitation"])
        .groupBy(_month().alias("month"))
        .agg(F.avg("temp_avg").alias("avg_temperature"), F.avg("precipitation").alias("avg_precipitation"))
        .orderBy("month")
    )


def metric_coverage_counts(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count("temp_min").alias("temp_coverage"),
        F.count("precipitation").alias("precip_coverage"),
        F.count("wind_speed").alias("wind_coverage"),
        F.count(F.lit(1)).alias("total_records"),
    )


def high_quality_temperatures(records: DataFrame) -> DataFrame:
    return records.filter((F.col("temp_validation") == "Valid") & (F.col("temp_quality") == "000"))


def physically_valid(records: DataFrame) -> DataFrame:
    test = F.lit(True)
    for c in _VALIDATIONS:
        test = test & (F.col(c).isNull() | (F.col(c) != "Invalid"))
    return records.filter(test)


def valid_precipitation(records: DataFrame) -> DataFrame:
    return records.filter(
        F.col("precipitation").isNotNull()
        & (F.col("precip_validation") == "Valid")
        & (F.col("precip_quality") == "0")
    )


def fully_valid_multi_metric(records: DataFrame) -> DataFrame:
    present = F.col("temp_min").isNotNull() & Q.has_precipitation() & Q.has_wind()
    return records.filter(present & _all_valid())
