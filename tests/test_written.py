"""Files that the workload writes: their headers come from the writer, lines from Arrow buffers."""

import zipfile

import pytest

from skyledger.workload import inputs as N


@pytest.fixture
def lines(spark):
    data = [("a", "TN_STAID000001.txt", 2, "b"), ("a", "TN_STAID000001.txt", 1, "é"), ("a", "TN_STAID000001.txt", None, "x"),
            ("a", "TX_STAID000001.txt", None, "y"), ("a", "stations.txt", 0, "s"), ("b", "TN_STAID000001.txt", 7, "")]
    return spark.createDataFrame(data, "archive string, entry string, pos long, line string")


TEXTS = {("a", "TN_STAID000001.txt"): "x\nh\nh\né\nb\n", ("a", "TX_STAID000001.txt"): "y\nh\nh\n", ("a", "stations.txt"): "s\n", ("b", "TN_STAID000001.txt"): "h\nh\n\n"}


def test_archives(spark, lines, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert {r.archive for r in N.write_archives(lines, str(tmp_path), "h\nh\n").collect()} == {"a", "b"}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {}
    for archive in "ab":
        with zipfile.ZipFile(tmp_path / archive) as z:
            got |= {(archive, e): z.read(e).decode() for e in z.namelist()}
    assert got == TEXTS


def test_station_files(spark, lines, tmp_path):
    files = lines.selectExpr("concat(archive, '/', entry) as file", "pos", "line")
    N.write_station_files(files, str(tmp_path), "h\nh\n").collect()
    assert {(p.parent.name, p.name): p.read_text() for p in tmp_path.glob("*/*.txt")} == TEXTS
