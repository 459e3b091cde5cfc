import datetime
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.operators import pivot as V

STATIONS = [(0, 1, "A0", 50.0, -1.0), (1, 1, "A1", 51.0, -1.5), (0, 2, "B0", 52.0, -2.0), (2, 1, "A2", 53.0, -3.0)]
DAY = datetime.date(2020, 1, 1)


def stations(spark):
    return spark.createDataFrame(
        STATIONS, "archive_ord int, station_id int, station_name string, latitude double, longitude double"
    )


def observations(spark, data):
    return spark.createDataFrame(
        data, "archive_ord int, station_id int, obs_date date, element string, value float, qflag int, seq long"
    )


def merged_by_hand(data, known):
    """Plain-Python merge: archives in order, rows in processing order."""
    out = {}
    archives = sorted({r[0] for r in data})
    for a in archives:
        mine = {}
        for _, sid, day, element, value, q, _ in sorted((r for r in data if r[0] == a), key=lambda r: r[6]):
            if (a, sid) not in known:
                continue
            rec = mine.setdefault((sid, day), {})
            rec[element] = value
            if element in S.TEMPERATURE_PREFIXES:
                rec["tq"] = rec.get("tq", "") + (str(q) if str(q) not in rec.get("tq", "") else "")
            else:
                rec["q" + element] = str(q)
        for key, rec in mine.items():
            target = out.setdefault(key, {"first": a})
            target.update(rec)
    return out


def random_rows(seed, n=400):
    r = random.Random(seed)
    return [
        (r.randrange(3), r.randrange(1, 4), datetime.date(2020, 1, r.randrange(1, 6)), r.choice(S.PREFIXES),
         float(r.randrange(-20, 20)), r.choice([0, 1, 9]), i)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_unified_records_against_plain_python(spark, seed):
    data = random_rows(seed)
    known = {(a, s): (n, la, lo) for a, s, n, la, lo in STATIONS}
    expected = merged_by_hand(data, known)
    shuffled = data[:]
    random.Random(9).shuffle(shuffled)
    one = V.unified_records(observations(spark, shuffled), stations(spark))
    two = V.merge_records(V.archive_records(observations(spark, shuffled), stations(spark)))
    got = one.collect()
    assert len(got) == len(expected)
    for r in got:
        e = expected[(r.station_id, r.date)]
        name, lat, lon = known[(e["first"], r.station_id)]
        assert (r.station_name, r.latitude, r.longitude) == (name, lat, lon)
        assert [r[c] for c in S.WEATHER_VALUES] == [e.get(p) for p in S.PREFIXES]
        assert (r.temp_quality, r.precip_quality, r.wind_quality) == (e.get("tq"), e.get("qRR"), e.get("qFG"))
    assert rows(one) == rows(two)


def test_positional_flags_follow_the_values(spark):
    data = [(0, 1, DAY, "TN", 1.0, 1, 0), (1, 1, DAY, "TX", 2.0, 0, 0), (2, 1, DAY, "RR", 2.0, 0, 0)]
    one = V.unified_records(observations(spark, data), stations(spark), "positional")
    two = V.merge_records(V.archive_records(observations(spark, data), stations(spark), "positional"), "positional")
    assert one.first().temp_quality == two.first().temp_quality == "190"
    rain = V.unified_records(observations(spark, data[2:]), stations(spark), "positional")
    assert rain.first().temp_quality is None


def test_merge_of_two_partial_records(spark):
    data = [(0, 1, DAY, "TN", 10.0, 0, 0)] + [
        (1, 1, DAY, e, v, 0, i) for i, (e, v) in enumerate([("TX", 20.0), ("TG", 15.0), ("RR", 5.5)])
    ]
    r = V.unified_records(observations(spark, data), stations(spark)).first()
    assert [r[c] for c in S.WEATHER_VALUES] == [10.0, 20.0, 15.0, 5.5, None]


@pytest.mark.parametrize("drop, incomplete, flags", [(None, False, ["000"]), ("TG", False, []), ("TG", True, ["090"])])
def test_consolidated(spark, drop, incomplete, flags):
    data = [(0, 2, DAY, e, v, 0, i) for i, (e, v) in enumerate([("TN", 15.0), ("TX", 25.0), ("TG", 20.0)]) if e != drop]
    only = stations(spark).filter("archive_ord = 0").drop("archive_ord")
    got = V.consolidated_records(observations(spark, data), only, incomplete).collect()
    assert [r.quality_flags for r in got] == flags
    if drop and got:
        assert got[0].avg_temp == -9999.0


def test_unknown_stations(spark):
    data = [(0, 1, DAY, "TN", 1.0, 0, 0), (1, 2, DAY, "TN", 1.0, 0, 1), (1, 2, DAY, "RR", 1.0, 0, 2)]
    found = V.unknown_stations(observations(spark, data), stations(spark), "archive_ord")
    assert rows(found) == [(1, 2, 2, 2)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of all rows on one key: the map side hands on one row per task and key."""
    data = [(0, 1, DAY, "TN", float(i), 0, i) for i in range(1000)] + random_rows(3, 500)
    wide = V.pivot_observations(observations(spark, data).repartition(4), False)
    plan = wide._jdf.queryExecution().toString()
    assert plan.count("partial_max_by") > 0 and "SortAggregate" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning(station_id") == 1


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        V.pivot_observations(observations(spark, random_rows(1, 2)), quality_mode="other")


@pytest.mark.parametrize("mode", V.QUALITY_MODES)
@pytest.mark.parametrize("listed", ["broadcast", "shuffle_hash"])
def test_rows_are_dealt_to_tasks_by_their_number(spark, monkeypatch, mode, listed):
    monkeypatch.setattr(V, "TASK_ROWS", 20)
    if listed != "broadcast":  # as for a list too long to send around
        monkeypatch.setattr(V, "join_hint", lambda df, larger=None: lambda x: x.hint(larger))
    obs, places = observations(spark, random_rows(3)), stations(spark)
    plain, dealt = V.archive_records(obs, places, mode), V.archive_records(obs, places, mode, rows=400)
    assert rows(dealt) == rows(plain)
    once, merged = V.merge_records(plain, mode), V.merge_records(dealt, mode, rows=400)
    assert rows(merged) == rows(once) == rows(V.unified_records(obs, places, mode, rows=400))
    if listed == "broadcast":
        assert dealt.rdd.getNumPartitions() == merged.rdd.getNumPartitions() == 20
    else:
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
