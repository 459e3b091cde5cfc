"""Profiles of tables that grow."""

import pytest
from conftest import rows

from skyledger import schemas as S
from skyledger.operators import profile as R
from skyledger.plans import jobs as J


def weather(spark, stations, day="2020-01-01"):
    made = spark.range(stations[0], stations[1]).selectExpr("id as station_id", f"sequence(date'{day}', date'{day}' + 2) as days").selectExpr("station_id", "explode(days) as date")
    made = made.selectExpr(
        "station_id", "concat('S', station_id) as station_name", "date", "cast(50 + station_id % 9 as double) as latitude", "cast(station_id % 7 as double) as longitude",
        "cast(if(station_id % 2 = 0, station_id % 60 - 20, null) as float) as temp_min", "cast(if(station_id % 2 = 0, station_id % 60, null) as float) as temp_max",
        "cast(null as float) as temp_avg", "cast(station_id % 700 as float) as precipitation", "cast(null as float) as wind_speed",
        "if(station_id % 2 = 0, '01', null) as temp_quality", "'0' as precip_quality", "cast(null as string) as wind_quality",
        "if(station_id % 2 = 0, 'Valid', null) as temp_validation", "'Suspect' as precip_validation", "cast(null as string) as wind_validation",
    )
    return made.select(S.WEATHER_COLUMNS)


def exact(records):
    per_station = R.station_profile(records)
    return {
        "bounds": rows(R.dataset_bounds(per_station).drop("total_stations")),
        "coverage": rows(R.metric_coverage(per_station).drop("stations")),
        "source_flags": rows(R.source_flag_counts(per_station)),
        "physical_validity": rows(R.physical_validity_counts(per_station)),
        "combined_quality": rows(R.combined_quality_counts(per_station)),
    }


def stripped(members):
    return {k: rows(m.drop("total_stations", "stations")) for k, m in members.items()}


def test_profile_reads_only_new_files(spark, tmp_path):
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    with pytest.raises(ValueError, match="no such file"):
        J.refresh_profile(spark, path, state)
    weather(spark, (0, 3000)).repartition(3).write.parquet(path)
    first = J.refresh_profile(spark, path, state)
    assert stripped(first) == exact(spark.read.parquet(path))
    weather(spark, (2000, 5000), "2021-05-01").repartition(2).write.mode("append").parquet(path)
    weather(spark, (0, 0)).write.mode("append").parquet(path)  # a file without rows
    old = [f for f in (tmp_path / "table").glob("*.parquet")]
    known = {r.file for r in spark.read.parquet(state).select("file").collect()}
    for f in old:  # the files known are gone for good: reading one would fail
        if f.name in known:
            (tmp_path / f.name).write_bytes(f.read_bytes())
            f.write_bytes(b"X" * f.stat().st_size)
            (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    second = J.refresh_profile(spark, path, state)
    got = stripped(second)
    stations = second["bounds"].first().total_stations
    by_metric = {r.metric: r.stations for r in second["coverage"].collect()}
    for f in old:
        if f.name in known:
            f.write_bytes((tmp_path / f.name).read_bytes())
    assert got == exact(spark.read.parquet(path))
    # three standard errors of 0.8 %
    assert abs(stations - 5000) <= 0.024 * 5000 and abs(by_metric["temperature"] - 2500) <= 0.024 * 2500
    assert by_metric["wind_speed"] == 0
    again = J.refresh_profile(spark, path, state)
    assert stripped(again) == got and spark.read.parquet(state).count() == len(list((tmp_path / "table").glob("*.parquet")))


def test_files_that_went_leave_the_profile(spark, tmp_path):
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    weather(spark, (0, 50)).coalesce(1).write.parquet(path)
    J.refresh_profile(spark, path, state)
    weather(spark, (100, 130)).coalesce(1).write.mode("overwrite").parquet(path)
    assert J.refresh_profile(spark, path, state)["bounds"].first().total_records == 90
