import os

import pytest
from conftest import STATION_TEXT, rows, station_file
from pyspark.errors import StreamingQueryException

from skyledger.operators import pivot as V
from skyledger.plans.store import RecordStore
from skyledger.sources import archives as A
from skyledger.sources import parsing as P
from skyledger.sources import stations as ST
from skyledger.streaming import landing as L


def land(folder, name, lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(station_file(lines))


def test_landed_files_equal_a_batch_run(spark, tmp_path, make_zip):
    folder, table, state = tmp_path / "landing", str(tmp_path / "table"), str(tmp_path / "state")
    (tmp_path / "stations.txt").write_text(STATION_TEXT)
    stations = ST.read_station_list(spark, str(tmp_path / "stations.txt"))

    def run():
        query = L.maintain_records(spark, str(folder), stations, table, state, buckets=4, max_files=2, tasks=2)
        query.awaitTermination()
        return rows(L.read_records(spark, table))

    a = {
        "a/TN_STAID000257.txt": ["1,20200101,100,0", "1,20200101,110,1"],
        "a/TX_STAID000257.txt": ["1,20200101,200,9"],
        "a/RR_STAID000258.txt": ["1,20200105,10,0", "1,20200106,x,0"],
    }
    b = {
        "b/TN_STAID000257.txt": ["1,20200101,90,0", "1,20200102,80,0"],
        "a/TG_STAID000257.txt": ["1,20200101,150,0"],
        "a/TN_STAID000777.txt": ["1,20200101,150,0"],
    }
    # the later archive lands first
    for name, lines in b.items():
        land(folder, name, lines)
    run()
    for name, lines in a.items():
        land(folder, name, lines)
    incremental = run()

    for archive in "ab":
        files = {n.split("/")[1]: station_file(x) for n, x in {**a, **b}.items() if n.startswith(archive)}
        order = ("TN", "TX", "TG", "RR", "FG")
        files = dict(sorted(files.items(), key=lambda f: order.index(f[0][:2])))
        make_zip(tmp_path / f"{archive}.zip", {"stations.txt": STATION_TEXT, **files})
    src = ST.open_archives(spark, str(tmp_path))
    assert incremental == rows(V.unified_records(src.observations, src.stations))
    assert run() == incremental  # nothing new: nothing changes

    # a replayed batch overwrites what it wrote before
    import shutil

    shutil.copytree(state, tmp_path / "state2")
    for commit in sorted((tmp_path / "state2" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))[-1:]:
        commit.unlink()
        (commit.parent / f".{commit.name}.crc").unlink(missing_ok=True)
    state = str(tmp_path / "state2")
    query = L.maintain_records(spark, str(folder), stations, table, state, buckets=4, max_files=2, tasks=2)
    query.awaitTermination()
    assert rows(L.read_records(spark, table)) == incremental


def test_stream_of_observations(spark, tmp_path):
    land(tmp_path / "in", "x/TN_STAID000257.txt", ["1,20200101,100,0", "1,20200102,-9999,9"])
    obs = L.stream_observations(spark, str(tmp_path / "in"), tasks=1)
    assert obs.isStreaming
    query = (
        obs.writeStream.format("memory").queryName("landed").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    query.awaitTermination()
    assert rows(spark.table("landed"), "station_id", "element", "value") == [(257, "TN", 10.0)]


def stations_of(spark, numbers):
    return spark.createDataFrame([(n, f"S{n}", 50.0, -1.0) for n in numbers], "station_id long, station_name string, latitude double, longitude double")


def land_many(folder, count):
    """Files of stations 1 to `count`, each newer than the one before; the later half has a second archive as well."""
    for n in range(1, count + 1):
        for archive in "ab" if n > count // 2 else "a":
            name = f"{archive}/TN_STAID{n:06d}.txt"
            land(folder, name, [f"1,202001{n % 28 + 1:02d},{n},{n % 2}", "1,20200301,7,0"])
            os.utime(folder / name, (1e9 + n, 1e9 + n))


def jobs_so_far(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_batches_of_lists_share_their_jobs(spark, tmp_path):
    land_many(tmp_path / "in", 40)  # 60 files
    stations = stations_of(spark, range(1, 40))  # one is unknown

    def run(name, max_files):
        before = jobs_so_far(spark)
        L.maintain_records(spark, str(tmp_path / "in"), stations, str(tmp_path / name), str(tmp_path / f"{name}-state"), buckets=2, max_files=max_files).awaitTermination()
        return rows(L.read_records(spark, str(tmp_path / name))), jobs_so_far(spark) - before

    (expected, _), (found, jobs) = run("at-once", 1000), run("in-turn", 2)
    batches = len(list((tmp_path / "in-turn-state" / "commits").glob("[0-9]*")))
    assert found == expected and len(found) == 78 and batches == 30
    assert jobs < 8 * batches  # 15 a batch before


def test_a_bad_file_fails_in_its_own_batch(spark, tmp_path):
    land_many(tmp_path / "in", 12)
    bad = tmp_path / "in/a/TN_STAID000004.txt"
    good = bad.read_text()
    land(tmp_path / "in", "a/TN_STAID000004.txt", ["1,20200101,x,0"])
    os.utime(bad, (1e9 + 4, 1e9 + 4))
    stations, table = stations_of(spark, range(1, 13)), str(tmp_path / "table")

    def run():
        L.maintain_records(spark, str(tmp_path / "in"), stations, table, str(tmp_path / "state"), buckets=2, max_files=1).awaitTermination()

    with pytest.raises(StreamingQueryException, match="bad value"):
        run()
    assert {r[0] for r in rows(L.read_records(spark, table))} >= {1, 2}  # lists of one time come in any order
    assert 4 not in {r[0] for r in rows(L.read_records(spark, table))}
    bad.write_text(good)
    RecordStore(spark, table).vacuum()  # what was worked off ahead is gone
    run()
    assert len(rows(L.read_records(spark, table))) == 24


def test_a_folder_that_was_worked_off_ahead_and_vacuumed_is_written_again(spark, tmp_path, monkeypatch):
    land_many(tmp_path / "in", 12)
    table, lay = str(tmp_path / "table"), RecordStore.lay

    def lay_and_vacuum(self, *args):
        manifest = lay(self, *args)
        for future, _ in list(begun[0].begun.values()):
            future.exception()  # done
        RecordStore(spark, table).vacuum(1)
        return manifest

    begun, made = [], L._Ahead.__init__
    monkeypatch.setattr(L._Ahead, "__init__", lambda self, *args: (made(self, *args), begun.append(self))[0])
    monkeypatch.setattr(RecordStore, "lay", lay_and_vacuum)
    L.maintain_records(spark, str(tmp_path / "in"), stations_of(spark, range(1, 13)), table, str(tmp_path / "state"), buckets=2, max_files=3).awaitTermination()
    assert len(rows(L.read_records(spark, table))) == 24


def test_files_are_put_into_lists_once(spark, tmp_path):
    land_many(tmp_path / "in", 10)
    for name in ("_hidden/TN_STAID000001.txt", "a/.TN_STAID000001.txt", "a/notes.txt", "a/TN_STAIDx.txt"):
        land(tmp_path / "in", name, [])
    lists, stations = str(tmp_path / "lists"), stations_of(spark, range(1, 10))

    def listed():
        return [spark.read.schema(L.LIST).parquet(str(p)).collect() for p in sorted((tmp_path / "lists").glob("*.parquet"), key=lambda p: p.name.split("-")[1])]

    L.list_landed(spark, str(tmp_path / "in"), lists, 4, stations)
    first = listed()
    assert [len(x) for x in first] == [4, 4, 4, 3]
    assert [r.station_id for x in first for r in x] == [1, 2, 3, 4, 5, 6, 6, 7, 7, 8, 8, 9, 9, 10, 10]  # by age
    assert {r.station_id for x in first for r in x if not r.opened} == {10}
    L.list_landed(spark, str(tmp_path / "in"), lists, 4, stations)
    assert listed() == first
    land(tmp_path / "in", "c/d/TN_STAID000003.txt", [])
    L.list_landed(spark, str(tmp_path / "in"), lists, 4, stations)
    assert sorted(len(x) for x in listed()) == [1, 3, 4, 4, 4]
