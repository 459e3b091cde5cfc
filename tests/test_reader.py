"""Archives through `spark.read.format` and SQL."""

import zipfile

import pytest
from conftest import STATION_TEXT, rows, station_file
from pyspark.sql import functions as F

from skyledger.operators import pivot as V
from skyledger.sources import archives as A, reader as R, stations as ST


def pack(path, files, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, text in files.items():
            z.writestr(name, text)


@pytest.fixture
def folder(tmp_path):
    many = [f"1,202001{d:02d},{d * n % 300},{d % 2}" for n in range(1, 40) for d in range(1, 29)]
    pack(
        tmp_path / "a.zip",
        {
            "stations.txt": STATION_TEXT,
            "TN_STAID000257.txt": station_file(many),
            "TX_STAID000258.txt": station_file(["1,20200101,200,0", "1,20200102,-9999,9"]),
            "RR_STAID000257.txt": station_file(["1,20200101,20,0", "1,20200102,x,0"]),
        },
    )
    pack(
        tmp_path / "b.zip",
        {"stations.txt": STATION_TEXT, "TN_STAID000257.txt": station_file(many[:500]), "FG_STAID000999.txt": station_file(["1,20200103,20,0"]), "TX_STAID000258.txt": station_file(many[::-1])},
        zipfile.ZIP_STORED,
    )
    pack(tmp_path / "_c.zip", {"stations.txt": STATION_TEXT, "TG_STAID000258.txt": station_file(["1,20200101,100,1"])})
    return tmp_path


def spoil(path, *entries):
    """Breaks the text of some entries, so that opening them fails."""
    with zipfile.ZipFile(path) as z:
        places = [(z.getinfo(e).header_offset, z.getinfo(e).compress_size) for e in entries]
    data = bytearray(path.read_bytes())
    for at, size in places:
        data[at : at + 4] = b"XXXX"
    path.write_bytes(bytes(data))


@pytest.mark.parametrize("share", [40, 700, 1 << 20])
def test_every_line_comes_once_at_its_place(spark, folder, share):
    found = R.lines(spark, str(folder), shareBytes=share)
    src = ST.open_archives(spark, str(folder))
    files = A.data_entries(src.entries, src.archives)
    expected = A.archive_lines(files, lineage=True)
    columns = ("archive", "archive_ord", "entry", "element", "station_id", "seq", "line")
    assert rows(found, *columns) == rows(expected, *columns)
    assert found.rdd.getNumPartitions() == sum(-(-f.stat().st_size // share) for f in folder.glob("*.zip"))


def test_filters_leave_entries_and_archives_unopened(spark, folder):
    spoil(folder / "b.zip", "FG_STAID000999.txt", "TX_STAID000258.txt")
    (folder / "_c.zip").write_bytes(b"no archive")
    found = R.lines(spark, str(folder))
    with pytest.raises(Exception, match="BadZipFile"):
        found.count()
    one = found.where("archive != 'q' and archive like 'b%' and station_id = 257 and element in ('TN', 'TX')")
    assert one.count() == 500
    assert found.where("archive in ('a.zip', 'b.zip') and station_id <= 257 and length(line) > 0").groupBy("archive").count().count() == 2
    assert found.where("archive = 'a.zip' and (element = 'TX' or station_id = 5)").count() == 2
    assert found.where("archive = 'none'").count() == 0
    assert found.where("archive like 'b%' and entry = 'TN_STAID000257.txt'").count() == 500
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "station_id" not in plan.split("BatchScan")[0].split("Filter")[-1].replace("isnotnull(station_id", "")
    typed = R.observations(spark, str(folder)).where("archive like 'b%' and station_id = 257")
    assert typed.count() == 500 and typed.agg(F.max("value")).first()[0] > 5


def test_options(spark, folder):
    got = R.lines(spark, str(folder), pattern="a", elements="TX, RR", stations="257")
    assert rows(got, "element", "line") == [("RR", "1,20200101,20,0"), ("RR", "1,20200102,x,0")]
    pack(folder / "d.zip", {"TN_STAID000257.txt": station_file([])})  # no station list
    (folder / "e.zip").write_bytes(b"")
    with pytest.raises(Exception, match="not found in archive|BadZipFile"):
        R.lines(spark, str(folder)).count()
    good = R.lines(spark, str(folder), damaged="skip")
    assert {r.archive for r in good.select("archive").distinct().collect()} == {"_c.zip", "a.zip", "b.zip"}
    assert R.stations(spark, str(folder), damaged="skip").groupBy("archive_ord").count().count() == 3
    assert R.lines(spark, str(folder / "a.zip"), stations="258").count() == 2
    for path, options in ((str(folder), {"damaged": "maybe"}), (str(folder / "nothing"), {}), (str(folder), {"pattern": "zzz"})):
        with pytest.raises(Exception, match="unknown choice|no such file|no valid zip"):
            R.lines(spark, path, **options).count()


def test_views_answer_sql(spark, folder):
    R.create_views(spark, str(folder), "some_")
    src = ST.open_archives(spark, str(folder))
    assert rows(spark.table("some_weather")) == rows(V.unified_records(src.observations, src.stations))
    spark.sql(f"create or replace temporary view some_lines using station_archives options (path '{folder}', stations '258')")
    got = spark.sql("select archive, element, count(*) as n from some_lines group by all order by all").collect()
    assert [tuple(r) for r in got] == [("_c.zip", "TG", 1), ("a.zip", "TX", 2), ("b.zip", "TX", 1092)]
    assert spark.sql("select count(*) from some_weather where station_id = 258 and temp_max is not null").first()[0] == 28


def test_names_with_underscores_and_dots_are_found(spark, tmp_path):
    for name in ("_x/TN_STAID000257.txt", ".y/TX_STAID000257.txt", "z/TG_STAID000257.txt", "z/other.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(station_file(["1,20200101,100,0"]))
    found = ST.read_station_files(spark, str(tmp_path))
    assert rows(found, "archive", "element") == [(".y", "TX"), ("_x", "TN"), ("z", "TG")]


def test_small_archives_are_read_several_by_a_task(spark, folder):
    assert R.lines(spark, str(folder)).rdd.getNumPartitions() == 1
    assert R.lines(spark, str(folder), metadata="stations.txt").rdd.getNumPartitions() == 1
    assert R.lines(spark, str(folder)).select("archive").distinct().count() == 3


def test_metadata_of_archives_is_read_by_many_tasks(spark, folder):
    found = ST.list_contents(spark, str(folder))
    lines = A.archive_metadata_lines(found.archives, "stations.txt")
    assert lines.rdd.getNumPartitions() > 1
    assert lines.groupBy("archive").count().count() == 3
