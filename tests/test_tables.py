import datetime
import os

import pytest
from conftest import ELEMENT_TEXT, STATION_TEXT, rows, station_file
from pyspark.sql import functions as F
from test_reports import random_weather, v1, weather

from skyledger import schemas as S
from skyledger.plans import jobs as J
from skyledger.sources import tables as T


@pytest.mark.parametrize("codec, stored", [("snappy", "SNAPPY"), ("gzip", "GZIP"), ("lz4", "LZ4"), ("zstd", "ZSTD"), ("none", "UNCOMPRESSED")])
def test_codecs(spark, tmp_path, codec, stored):
    records = weather(spark, random_weather(1, 50))
    path = str(tmp_path / "t")
    assert T.write_weather(records, path, codec)
    assert rows(T.read_weather(spark, path)) == rows(records)
    assert T.table_statistics(spark, path).first().codecs == stored


def test_unknown_codec_is_refused_before_work(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported compression"):
        T.write_weather(weather(spark, []), str(tmp_path / "t"), "brotli")


def test_empty_result_writes_nothing(spark, tmp_path):
    assert T.write_weather(weather(spark, []), str(tmp_path / "t")) is False
    assert T.write_consolidated(v1(spark, []), str(tmp_path / "u")) is False
    assert not os.listdir(tmp_path)


def test_sorted_files_and_row_groups(spark, tmp_path):
    records = weather(spark, random_weather(2, 3000))
    path = str(tmp_path / "t")
    T.write_weather(records, path, row_group_rows=100)
    files = T.file_statistics(spark, path).collect()
    assert sum(f.rows for f in files) == records.count()
    assert max(max(f.row_group_rows) for f in files) <= 200  # checked by the writer every 100 rows
    last = None
    for f in sorted(files, key=lambda f: f.file):
        keys = [(r.station_id, r.date) for r in spark.read.parquet(f.file).collect()]
        assert keys == sorted(keys) and (last is None or last < keys[0])
        last = keys[-1]


def test_layouts(spark, tmp_path):
    records = weather(spark, random_weather(3, 30))
    assert T.detect_layout(records) == "weather"
    old = records.drop(*S.VALIDATION_COLUMNS)
    assert T.detect_layout(old) == "weather"
    assert T.detect_layout(records.drop("date")) == "unknown"
    assert T.detect_layout(v1(spark, [])) == "consolidated"
    assert T.as_weather(old).select("temp_validation").distinct().collect()[0][0] is None
    assert T.as_weather(v1(spark, [])).count() == 0
    odd = records.selectExpr(*[c if c != "temp_validation" else "'Strange' as temp_validation" for c in S.WEATHER_COLUMNS])
    assert T.as_weather(odd).filter("temp_validation is not null").count() == 0


def test_unsigned_ids_are_read(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = [pa.uint32(), pa.string(), pa.date32(), pa.float64(), pa.float64(), *[pa.float32()] * 3, pa.string()]
    row = [7, "A", datetime.date(2020, 1, 1), 51.0, 0.0, 1.0, 3.0, 2.0, "000"]
    table = pa.table([pa.array([v], k) for v, k in zip(row, kinds)], names=S.CONSOLIDATED_COLUMNS)
    pq.write_table(table, tmp_path / "x.parquet")
    got = T.read_consolidated(spark, str(tmp_path / "x.parquet"), limit=5)
    assert dict(got.dtypes)["station_id"] == "bigint" and tuple(got.first()) == tuple(row)


def test_profile_of_both_layouts(spark, tmp_path):
    T.write_weather(weather(spark, random_weather(6, 200)), str(tmp_path / "w"))
    profile = J.profile_dataset(spark, str(tmp_path / "w"), sample=5)
    assert profile.layout == "weather"
    assert profile.members["sample"].count() == 5
    total = profile.members["bounds"].first().total_records
    limited = J.profile_dataset(spark, str(tmp_path / "w"), limit=10)
    assert total > 10 and limited.members["bounds"].first().total_records == 10
    day = datetime.date(2020, 1, 1)
    T.write_consolidated(v1(spark, [(1, "A", day, 51.0, 0.0, 1.0, 3.0, 2.0, "000")]), str(tmp_path / "v"))
    assert J.profile_dataset(spark, str(tmp_path / "v")).members["statistics"].first().total_records == 1
    spark.range(1).write.parquet(str(tmp_path / "z"))
    with pytest.raises(ValueError, match="layout"):
        J.profile_dataset(spark, str(tmp_path / "z"))


def archive(make_zip, path, values, station=257):
    rows_ = {e: station_file([f"1,{d},{v},{q}" for d, v, q in r]) for e, r in values.items()}
    files = {f"{e}_STAID{station:06d}.txt": t for e, t in rows_.items()}
    return make_zip(path, {"stations.txt": STATION_TEXT, "elements.txt": ELEMENT_TEXT, **files})


def test_directory_job(spark, tmp_path, make_zip):
    folder = tmp_path / "in"
    folder.mkdir()
    archive(make_zip, folder / "b.zip", {"TX": [(20200101, 200, 0), (20200102, 90, 1)]})
    archive(make_zip, folder / "a.zip", {"TN": [(20200101, 100, 0)], "TX": [(20200101, 150, 1)], "RR": [(20200103, 5, 0)]})
    archive(make_zip, folder / "c.zip", {"TG": [(20200101, 300, 0)]}, station=258)
    job = J.process_directory(spark, str(folder), str(tmp_path / "out"))
    assert job.written
    got = rows(job.records, "station_id", "date", "temp_min", "temp_max", "temp_quality")
    day = lambda d: datetime.date(2020, 1, d)
    assert got == [
        (257, day(1), 10.0, 20.0, "0"),  # b is the later archive: its value and its flags
        (257, day(2), None, 9.0, "1"),
        (257, day(3), None, None, None),
        (258, day(1), None, None, "0"),
    ]
    assert job.composition.first().available_metrics == "temperature,precipitation"
    # per-archive rows are counted once per archive, unified rows once
    assert job.per_archive.totals.first().total_records == 5
    assert job.unified.totals.first().total_records == 4
    assert job.unified.totals.first().valid_records == 0


def test_station_filter_leaves_the_report_alone(spark, tmp_path, make_zip):
    archive(make_zip, tmp_path / "a.zip", {"TN": [(20200101, 100, 0)]})
    archive(make_zip, tmp_path / "c.zip", {"TG": [(20200101, 300, 0)]}, station=258)
    job = J.process_directory(spark, str(tmp_path), station=258)
    assert rows(job.records, "station_id") == [(258,)]
    assert job.per_archive.totals.first().total_records == 2
    narrow = J.process_directory(spark, str(tmp_path), station=258, filter_report=True)
    assert narrow.per_archive.totals.first().total_records == 1


def test_one_archive_and_validation(spark, tmp_path, make_zip):
    path = archive(make_zip, tmp_path / "a.zip", {"TN": [(20200101, 990, 0)]})
    archive(make_zip, tmp_path / "aa.zip", {"TN": [(20200101, 100, 0)]})
    job = J.process_archive(spark, path)
    assert rows(job.records, "temp_min", "temp_validation") == [(99.0, "Invalid")]
    assert job.written is None
    assert rows(J.validate(spark, path).unified.violations, "violation") == [("OutOfRange",)]
    with pytest.raises(ValueError, match="not a zip"):
        J.process_archive(spark, str(tmp_path / "a.txt"))


def test_nothing_to_write(spark, tmp_path, make_zip):
    folder = tmp_path / "in"
    folder.mkdir()
    archive(make_zip, folder / "a.zip", {"TN": [(20200101, 100, 0)]})
    job = J.process_directory(spark, str(folder), str(tmp_path / "out"), station=1)
    assert job.written is False and not (tmp_path / "out").exists()


def test_scratch_folder_without_a_shared_folder():
    from types import SimpleNamespace

    from skyledger.tuning import scratch_folder

    def session(master):
        settings = {}
        return SimpleNamespace(
            conf=SimpleNamespace(get=settings.get, set=settings.__setitem__),
            sparkContext=SimpleNamespace(master=master),
            settings=settings,
        )

    assert scratch_folder(local := session("local[4]")) and not local.settings
    for master in ("local-cluster[3,2,3000]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError):
            scratch_folder(session(master))


def test_sorted_files_without_a_range_exchange(spark, tmp_path):
    rows_ = spark.range(20_000).selectExpr("id % 7 + 1 as station_id", "date'2000-01-01' + cast(id % 1500 as int) as date")
    hot = rows_.unionAll(spark.range(8_000).selectExpr("3L as station_id", "date'2000-01-01' + cast(id % 1500 as int) as date"))
    wide = hot.distinct().select("station_id", "date", *[F.lit(None).cast(S.WEATHER[c].dataType).alias(c) for c in S.WEATHER_COLUMNS if c not in ("station_id", "date")])
    records = wide.select(S.WEATHER_COLUMNS)
    dealt = T.in_sorted_files(records, hot, file_rows=4000)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    dealt.write.parquet(str(tmp_path / "t"))
    spans = []
    for file in sorted((tmp_path / "t").glob("*.parquet")):
        keys = [(r.station_id, r.date) for r in spark.read.parquet(str(file)).select("station_id", "date").collect()]
        assert keys == sorted(keys)
        spans.append((keys[0], keys[-1]))
    assert 5 <= len(spans) <= 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert spark.read.parquet(str(tmp_path / "t")).count() == records.count()
    assert T.in_sorted_files(records, hot.limit(0)).rdd.getNumPartitions() == 1
