import datetime
import io

import numpy as np
import pytest
from conftest import ELEMENT_TEXT, HEADER, STATION_TEXT, rows, station_file
from pyspark.sql import functions as F

from skyledger.operators import pivot as V
from skyledger.plans import jobs as J
from skyledger.sources import archives as A
from skyledger.sources import parsing as P
from skyledger.sources import ranges
from skyledger.sources import stations as ST

TN = ["101, 19500101, 125, 0", "101, 19500102, -9999, 9", "", "101, 19500103,-15,1", "101,19500104,20, 9"]
TX = ["  7,19500101,200,0", "7,19500103,600,0", "7,19500105"]
RR = ["9,19500101,55,0", "9,bad,55,0", "9,19500102,x,0", "9,19500103,12.5,200", "9,19500104,7,300", "zz,19500106,7,0"]


def archive_files(**more):
    files = {
        "stations.txt": STATION_TEXT,
        "elements.txt": ELEMENT_TEXT,
        "metadata.txt": "free text",
        "TX_STAID000257.txt": station_file(TX),
        "TN_STAID000257.txt": station_file(TN),
        "RR_STAID000257.txt": station_file(RR),
        "TN_STAID000999.txt": station_file(["this, station, is, unknown"]),
        "dir/TN_STAID000001.txt": station_file(["1,19500101,1,0"]),
    }
    files.update(more)
    return files


@pytest.mark.parametrize("text", [b"", b"\n", b"a", b"a\n", b"a\nbb\n\nccc", b"x" * 50 + b"\n" + b"y" * 3 + b"\n", "é\nüü\n".encode()])
@pytest.mark.parametrize("header", [0, 1, 3])
def test_any_cut_into_ranges_yields_each_line_once(monkeypatch, text, header):
    monkeypatch.setattr(ranges, "BLOCK", 4)
    whole = text.split(b"\n")
    starts = np.cumsum([0] + [len(w) + 1 for w in whole])[:-1]
    if whole[-1] == b"":
        whole, starts = whole[:-1], starts[:-1]
    expected = [(int(s), w.decode()) for s, w in zip(starts, whole)][header:]
    for size in (1, 2, 3, 7, 100):
        got = []
        for lo in range(0, max(len(text), 1), size):
            for offsets, lines in ranges.lines_in_range(io.BytesIO(text), lo, lo + size, header):
                got += list(zip(offsets.tolist(), lines.to_pylist()))
        assert got == expected


def test_archive_observations(spark, tmp_path, make_zip):
    make_zip(tmp_path / "a.zip", archive_files())
    src = ST.open_archives(spark, str(tmp_path))
    day = lambda d: datetime.date(1950, 1, d)
    got = rows(src.observations, "element", "station_id", "obs_date", "value", "qflag")
    f = lambda x: float(np.float32(x))
    assert got == sorted(
        [
            ("TN", 257, day(1), 12.5, 0),
            ("TN", 257, day(3), -1.5, 1),
            ("TN", 257, day(4), 2.0, 9),
            ("TX", 257, day(1), 20.0, 0),
            ("TX", 257, day(3), 60.0, 0),
            ("RR", 257, day(1), 5.5, 0),
            ("RR", 257, day(3), 1.25, 200),
            ("RR", 257, day(6), f(0.7), 0),  # the source id of such files is not looked at
        ],
        key=lambda t: tuple(map(str, t)),
    )
    # the unknown station's broken file neither fails the job nor gives rows
    assert rows(src.unknown_stations(), "entry", "station_id") == [("TN_STAID000999.txt", 999)]
    assert rows(P.defective_lines(src.parsed).filter("station_id = 257"), "element", "defect") == [
        ("RR", "date: bad"),
        ("RR", "flag: 300"),
        ("RR", "value: x"),
    ]


def test_station_list_rules(spark, tmp_path, make_zip):
    make_zip(tmp_path / "a.zip", archive_files())
    got = {r.station_id: r for r in ST.open_archives(spark, str(tmp_path)).stations.collect()}
    assert set(got) == {1, 257, 258}
    assert got[257].station_name == "LONDON AGAIN" and got[257].elevation is None
    assert abs(got[257].latitude - 51.507222) < 1e-6 and abs(got[257].longitude + 0.1275) < 1e-9
    assert got[258].latitude == 53.5 and got[258].elevation is None
    assert got[1].elevation == 166


@pytest.mark.parametrize(
    "line", ["x,19500101,5,0", "1,19500230,5,0", "1,19500101,5.5,0", "1,19500101,5,5", "1,19500101,5,", "x,19500101,-9999,0"]
)
def test_bad_temperature_line_fails_the_job(spark, tmp_path, make_zip, line):
    make_zip(tmp_path / "a.zip", archive_files(**{"TG_STAID000257.txt": station_file([line])}))
    src = ST.open_archives(spark, str(tmp_path))
    with pytest.raises(Exception, match="station 257, bad"):
        src.observations.count()
    lenient = ST.open_archives(spark, str(tmp_path), temperature_defects="drop")
    assert lenient.observations.count() == 8


def test_missing_value_is_skipped_before_its_flag(spark, tmp_path, make_zip):
    make_zip(tmp_path / "a.zip", archive_files(**{"TG_STAID000257.txt": station_file(["1,19500101,-9999,x", "1,2,3"])}))
    assert ST.open_archives(spark, str(tmp_path)).observations.count() == 8


def test_header_is_twenty_physical_lines(spark, tmp_path, make_zip):
    short = {"stations.txt": STATION_TEXT, "TN_STAID000257.txt": "head\n" + "1,19500101,5,0\n" * 3}
    make_zip(tmp_path / "a.zip", short)
    assert ST.open_archives(spark, str(tmp_path)).observations.count() == 0
    assert ST.open_archives(spark, str(tmp_path), header_lines=1).observations.count() == 3


@pytest.mark.parametrize("split", [16, 100, 1 << 20])
def test_splits_do_not_change_the_result(spark, tmp_path, make_zip, split):
    make_zip(tmp_path / "a.zip", archive_files())
    whole = ST.open_archives(spark, str(tmp_path))
    cut = ST.open_archives(spark, str(tmp_path), split_bytes=split)
    assert rows(cut.observations) == rows(whole.observations)


def test_entries_can_be_left_unread(spark, tmp_path, make_zip):
    make_zip(tmp_path / "a.zip", archive_files(**{"TG_STAID000258.txt": station_file(["garbage,x,y,z"])}))
    only = ST.open_archives(spark, str(tmp_path), elements=["TN"], stations=[257])
    assert {r.element for r in only.observations.collect()} == {"TN"}


def test_discovery(spark, tmp_path, make_zip):
    make_zip(tmp_path / "UK_ALL_b.zip", archive_files())
    make_zip(tmp_path / "UK_ALL_a.zip", archive_files())
    make_zip(tmp_path / "OTHER.zip", archive_files())
    make_zip(tmp_path / "UK_ALL_nodata.zip", {"stations.txt": STATION_TEXT})
    make_zip(tmp_path / "UK_ALL_nostations.zip", {"TN_STAID000257.txt": station_file(TN)})
    make_zip(tmp_path / "UK_ALL_nocountry.zip", archive_files(**{"stations.txt": "1,A,GBR,1,1,1\n"}))
    (tmp_path / "UK_ALL_broken.zip").write_bytes(b"not a zip")
    (tmp_path / "UK_ALL_notes.txt").write_text("x")
    (tmp_path / "sub").mkdir()
    make_zip(tmp_path / "sub" / "UK_ALL_deep.zip", archive_files())
    src = ST.open_archives(spark, str(tmp_path), pattern="UK_ALL_")
    assert rows(src.archives, "archive_ord", "archive") == [(0, "UK_ALL_a.zip"), (1, "UK_ALL_b.zip")]
    assert [r[0] for r in rows(src.errors)] == [
        "UK_ALL_broken.zip", "UK_ALL_nocountry.zip", "UK_ALL_nodata.zip", "UK_ALL_nostations.zip",
    ]
    with pytest.raises(ValueError, match="no valid zip"):
        ST.open_archives(spark, str(tmp_path), pattern="broken")


def test_catalog(spark, tmp_path, make_zip):
    make_zip(tmp_path / "a.zip", archive_files())
    job = J.describe_archives(spark, str(tmp_path))
    row = job.catalog.first()
    assert row.total_files == 8 and row.station_count == 2 and row.elements == "TN,TX,RR"
    assert row.has_temperature_data and not row.has_complete_temperature
    assert (row.files_TN, row.coverage_TN, row.coverage_TX) == (2, 1.0, 0.5)
    country = job.countries.first()
    assert (country.country, country.country_count, country.countries) == ("GB", 2, "GB,SE")
    dates = job.dates.first()
    assert (dates.first_date, dates.last_date) == (datetime.date(1950, 1, 1), datetime.date(1950, 1, 6))
    assert rows(job.unlisted) == [("a.zip", "RR")]
    assert tuple(job.summary.first()) == (1, 8, 3)


def test_metric_order_follows_first_entries(spark, tmp_path, make_zip):
    # TX comes first in the archive, so its flag is first in the text
    tn, tx = station_file(["1,19500101,10,1"]), station_file(["1,19500101,20,0"])
    make_zip(tmp_path / "a.zip", {"stations.txt": STATION_TEXT, "TX_STAID000257.txt": tx, "TN_STAID000257.txt": tn})
    src = ST.open_archives(spark, str(tmp_path))
    assert V.unified_records(src.observations, src.stations).first().temp_quality == "01"


def test_last_line_wins(spark, tmp_path, make_zip):
    lines = station_file(["1,19500101,10,1", "1,19500101,30,0", "1,19500102,5,0"])
    files = {"stations.txt": STATION_TEXT, "TN_STAID000257.txt": lines, "RR_STAID000257.txt": lines}
    make_zip(tmp_path / "a.zip", files)
    src = ST.open_archives(spark, str(tmp_path), split_bytes=20)
    row = V.unified_records(src.observations, src.stations).orderBy("date").first()
    assert (row.temp_min, row.precipitation, row.temp_quality, row.precip_quality) == (3.0, 3.0, "10", "0")


def v1_base(tmp_path, stations=STATION_TEXT):
    files = {
        "uk_temp_min/stations.txt": stations,
        "uk_temp_min/TN_STAID000257.txt": station_file(TN),
        "uk_temp_min/TN_STAID000001.txt": station_file(["not,a,uk,station"]),
        "uk_temp_max/TX_STAID000257.txt": station_file(TX),
        "uk_temp_max/TN_STAID000257.txt": station_file(["wrong,folder,for,it"]),
        "uk_temp_avg/TG_STAID000257.txt": station_file(["5,19500101,150,0", "5,19500107,100,1"]),
        "uk_temp_avg/notes.txt": "x",
    }
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    return str(tmp_path)


@pytest.mark.parametrize("split", [50, 1 << 20])
def test_folders(spark, tmp_path, split):
    src = ST.open_folders(spark, v1_base(tmp_path), split_bytes=split)
    assert rows(src.observations.groupBy("element").count()) == [("TG", 2), ("TN", 3), ("TX", 2)]
    complete = V.consolidated_records(src.observations, src.stations)
    assert rows(complete, "min_temp", "max_temp", "avg_temp", "quality_flags") == [(12.5, 20.0, 15.0, "000")]
    loose = V.consolidated_records(src.observations, src.stations, allow_incomplete=True)
    assert [r[1] for r in rows(loose, "date", "quality_flags")] == ["000", "190", "999", "919"]


def test_folder_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    job = J.consolidate_folders(spark, v1_base(tmp_path / "in"), str(tmp_path / "out"), allow_incomplete=True)
    assert job.written and spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert job.totals.first().total_records == 4


def test_one_station_and_one_file(spark, tmp_path):
    base = v1_base(tmp_path)
    assert ST.open_folders(spark, base, station=257).observations.count() == 7
    one = ST.read_station_files(spark, f"{base}/uk_temp_min/TN_STAID000257.txt")
    assert rows(one, "value") == [(-1.5,), (12.5,), (2.0,)]
    assert ST.read_station_files(spark, f"{base}/uk_temp_min", station=257).count() == 3


def test_same_station_twice_in_a_folder(spark, tmp_path):
    base = v1_base(tmp_path)
    (tmp_path / "uk_temp_min" / "TN_STAID257.txt").write_text(station_file(["1,19500101,99,0"]))
    src = ST.open_folders(spark, base, station=257)
    row = V.consolidated_records(src.observations, src.stations).first()
    assert abs(row.min_temp - 9.9) < 1e-6  # the later file name wins


def test_invalid_utf8_and_crlf(spark, tmp_path):
    p = tmp_path / "TN_STAID000257.txt"
    p.write_bytes(HEADER.encode() + b"1,19500101,10,0\r\n1,19500102,\xff,0\r\n1,19500103,30,0")
    got = ST.read_station_files(spark, str(p), temperature_defects="drop")
    assert rows(got, "value") == [(1.0,), (3.0,)]


def test_folder_names_with_pattern_signs(spark, tmp_path, make_zip):
    odd = tmp_path / "a [b] {c}"
    (odd / "day=1").mkdir(parents=True)
    make_zip(odd / "x y.zip", archive_files())
    make_zip(odd / "day=1" / "z.zip", archive_files())
    src = ST.open_archives(spark, str(odd))
    assert rows(src.archives, "archive") == [("x y.zip",)]
    assert src.observations.count() == 8
    with pytest.raises(ValueError, match="no valid zip"):
        ST.open_archives(spark, str(tmp_path / "absent"))


def test_archives_that_cannot_be_used_are_reported(spark, tmp_path, make_zip):
    """Damaged data, unknown packing, encryption, hidden names and large station numbers."""
    import zipfile

    make_zip(tmp_path / "_x.zip", archive_files())
    make_zip(tmp_path / ".y.zip", archive_files())
    big = archive_files()
    big["stations.txt"] = big["stations.txt"] + "3000000000,FAR,GB,+51:30:26,-000:07:39,1\n"
    big["TN_STAID3000000000.txt"] = station_file(["1,19500101,10,0"])
    big["TN_STAID4294967296.txt"] = station_file(["1,19500101,10,0"])
    make_zip(tmp_path / "big.zip", big)
    with zipfile.ZipFile(make_zip(tmp_path / "good.zip", archive_files())) as z:
        info = z.getinfo("stations.txt")
    data = (tmp_path / "good.zip").read_bytes()
    at = info.header_offset + 30 + len("stations.txt")
    (tmp_path / "damaged.zip").write_bytes(data[:at] + b"\xff" * 40 + data[at + 40 :])
    head = data.index(b"PK\x01\x02", data.index(b"PK\x01\x02") + 1 if info.header_offset else 0)
    for k, entry in enumerate(zipfile.ZipFile(tmp_path / "good.zip").infolist()):
        if entry.filename == "stations.txt":
            head = [i for i in range(len(data)) if data.startswith(b"PK\x01\x02", i)][k]
    (tmp_path / "locked.zip").write_bytes(data[: head + 8] + b"\x01\x00" + data[head + 10 :])
    (tmp_path / "packing.zip").write_bytes(data[: head + 10] + b"\x63\x00" + data[head + 12 :])
    src = ST.open_archives(spark, str(tmp_path))
    assert [r[0] for r in rows(src.archives, "archive")] == [".y.zip", "_x.zip", "big.zip", "good.zip"]
    assert [r[0] for r in rows(src.errors)] == ["damaged.zip", "locked.zip", "packing.zip"]
    assert rows(src.observations.filter("station_id = 3000000000"), "element", "value") == [("TN", 1.0)]
    assert src.observations.count() == 4 * 8 + 1


def test_lines_are_read_by_place_without_joins(spark, tmp_path, make_zip):
    make_zip(tmp_path / "a.zip", archive_files())
    src = ST.open_archives(spark, str(tmp_path))
    plan = src.observations._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Join" not in above
    assert {r.station_id for r in src.lines.collect()} <= {r.station_id for r in src.stations.collect()}


def test_uncompressed_entries_are_cut(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_STORED) as z:
        for name, text in archive_files().items():
            z.writestr(name, text)
    whole = rows(ST.open_archives(spark, str(tmp_path)).observations)
    assert rows(ST.open_archives(spark, str(tmp_path), split_bytes=25).observations) == whole and len(whole) == 8


def test_catalog_reads_no_coordinates(spark, tmp_path, make_zip):
    from skyledger.plans import jobs as J

    files = archive_files()
    files["stations.txt"] = files["stations.txt"] + "9,BAD,GB,+51:99:26,-000:07:39,1\n"
    files["elements.txt"] = "QQ1,radiation,W/m2\n"
    make_zip(tmp_path / "a.zip", files)
    job = J.describe_archives(spark, str(tmp_path))
    assert job.catalog.count() == 1 and job.dates.count() == 1
    assert {r.element for r in job.unlisted.collect()} == {r.element for r in job.per_element.collect()}
