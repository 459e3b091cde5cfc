import datetime
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import quality as Q
from skyledger.operators import catalog as C
from skyledger.operators import integrity as I
from skyledger.operators import neighbours as NB
from skyledger.operators import profile as R
from skyledger.operators.batches import process_in_batches
from skyledger.plans import documented as D


def weather(spark, data):
    kinds = (
        "station_id int, station_name string, date date, latitude double, longitude double, temp_min float, "
        "temp_max float, temp_avg float, precipitation float, wind_speed float, temp_quality string, "
        "precip_quality string, wind_quality string"
    )
    return Q.with_physical_validity(spark.createDataFrame(data, kinds))


def random_weather(seed, n=500, stations=6):
    r = random.Random(seed)
    keys = {(r.randrange(1, stations + 1), datetime.date(1999, 1, 1) + datetime.timedelta(r.randrange(1500))) for _ in range(n)}
    pick = lambda *v: r.choice(v)
    out = []
    for sid, day in sorted(keys):
        t = [pick(None, float(r.randrange(-95, 66))) for _ in range(3)]
        rain, wind = pick(None, float(r.randrange(-5, 2100))), pick(None, float(r.randrange(-5, 130)))
        out.append(
            (sid, f"S{sid % 4}", day, 50.0 + sid, -6.0 + sid, *t, rain, wind,
             pick("000", "0", "01", "9", "190") if any(v is not None for v in t) else None,
             pick("0", "1", "9") if rain is not None else None, pick("0", "1", "9") if wind is not None else None)
        )
    return out


def test_jumps_over_years_and_gaps(spark):
    day = datetime.date
    data = [
        (1, "A", day(2019, 12, 31), 50.0, 0.0, 0.0, 10.0, None, None, None, "0", None, None),
        (1, "A", day(2021, 5, 1), 50.0, 0.0, 25.0, None, 5.0, None, None, "0", None, None),  # a year is skipped
        (1, "A", day(2021, 5, 2), 50.0, 0.0, None, 40.0, 26.0, None, None, "0", None, None),
        (1, "A", day(2022, 1, 1), 50.0, 0.0, 20.0, 19.0, 26.0, None, None, "0", None, None),
        (2, "B", day(2022, 1, 1), 50.0, 0.0, -50.0, 50.0, 0.0, None, None, "0", None, None),
    ]
    got = rows(I.weather_jumps(weather(spark, data)), "station_id", "date", "part", "previous_date", "jump")
    assert got == [
        (1, day(2021, 5, 1), "min", day(2019, 12, 31), 25.0),
        (1, day(2021, 5, 2), "avg", day(2021, 5, 1), 21.0),
        (1, day(2022, 1, 1), "max", day(2021, 5, 2), 21.0),
    ]


@pytest.mark.parametrize("size", [3, 10, 50])
def test_diverse_sample_against_plain_python(spark, size):
    data = random_weather(4)
    total = len(data)
    step = total // (size * 50) if total > size * 100 else max(1, total // size)
    taken, per_name = [], {}
    for i, r in enumerate(data):
        if i % step == 0 and len(taken) < size and per_name.get(r[1], 0) < 2:
            taken.append(r)
            per_name[r[1]] = per_name.get(r[1], 0) + 1
    for r in data[:: step * 2]:
        if len(taken) < size and not any((t[1], t[2]) == (r[1], r[2]) for t in taken):
            taken.append(r)
    got = R.diverse_sample(weather(spark, data).repartition(5), size).collect()
    assert [(g.station_id, g.date) for g in got] == [(t[0], t[2]) for t in taken]


def test_quality_counts_add_up(spark):
    records = weather(spark, random_weather(5)).cache()
    n = records.count()
    assert sum(r.n for r in R.combined_quality_counts(R.station_profile(records)).collect()) == 3 * n
    graded = records.selectExpr("count(temp_validation) + count(precip_validation) + count(wind_validation)").first()[0]
    assert sum(r.n for r in R.physical_validity_counts(R.station_profile(records)).collect()) == graded
    totals = I.integrity_totals(records).first()
    assert totals.total_records == n
    assert totals.invalid_records == I.violations(records).count()
    assert I.station_statistics(records).agg(F.sum("total_records")).first()[0] == n
    bounds = R.dataset_bounds(R.station_profile(records)).first()
    assert (bounds.total_records, bounds.total_stations) == (n, 6)
    records.unpersist()


def test_extremes_break_ties_by_key(spark):
    day = datetime.date
    base = (50.0, 0.0)
    data = [
        (2, "B", day(2020, 1, 1), *base, -5.0, 30.0, None, 10.0, 5.0, "0", "0", "0"),
        (1, "A", day(2020, 1, 2), *base, -5.0, 30.0, None, 10.0, 5.0, "0", "0", "0"),
        (1, "A", day(2020, 1, 1), *base, -95.0, 99.0, None, 5000.0, 500.0, "0", "0", "0"),  # impossible
        (3, "C", day(2020, 1, 1), *base, None, None, 1.0, None, None, "0", None, None),
    ]
    got = rows(R.extreme_records(weather(spark, data)), "extreme", "station_id", "date")
    assert got == [(e, 1, day(2020, 1, 2)) for e in ("coldest", "hottest", "wettest", "windiest")]


def test_empty_inputs(spark):
    none = weather(spark, [])
    assert R.composition(none).first().temperature_percent is None
    assert I.summary_percentages(I.integrity_totals(none)).first().valid_percent is None
    assert R.extreme_records(none).count() == 0
    assert R.diverse_sample(none, 5).count() == 0
    assert R.diverse_sample(weather(spark, random_weather(1, 5)), 0).count() == 0


def v1(spark, data):
    kinds = (
        "station_id int, station_name string, date date, latitude double, longitude double, min_temp float, "
        "max_temp float, avg_temp float, quality_flags string"
    )
    return spark.createDataFrame(data, kinds)


def test_v1_reports(spark):
    day = datetime.date
    a, m = ("A", 51.0, 0.0), -9999.0
    data = [
        (1, "A", day(2020, 1, 1), 51.0, 0.0, 10.0, 20.0, 15.0, "000"),
        (1, "A", day(2020, 1, 2), 51.0, 0.0, 16.5, 20.0, 15.0, "010"),
        (1, "A", day(2020, 1, 3), 51.0, 0.0, 60.0, 61.0, 60.0, "000"),
        (1, "A", day(2020, 1, 4), 51.0, 0.0, m, 20.0, 15.0, "900"),
    ]
    records = v1(spark, data)
    assert tuple(I.v1_totals(records).first()) == (4, 2, 1, 1, 1)
    assert len(rows(I.v1_range_violations(records))) == 3
    assert [r[2] for r in rows(I.v1_relation_violations(records))] == ["MinGreaterThanAvg"]
    # the older checker also reports range breaks and absent values under this name
    assert len(rows(I.v1_relation_violations(records, parity=True))) == 3
    stats = I.v1_station_statistics(records).first()
    assert (stats.min_temp, stats.max_temp, stats.avg_temp) == (10.0, 61.0, 26.25)
    parity = I.v1_station_statistics(records, parity=True).first()
    assert (parity.max_temp, parity.avg_temp) == (60.0, None)
    profile = R.v1_statistics(records).first()
    assert (profile.min_temp, profile.min_temp_place) == (10.0, "A (2020-01-01)")
    assert (profile.max_temp, profile.avg_temp, profile.complete_records) == (20.0, 15.0, 3)
    jumps = rows(I.v1_jumps(records), "date", "part")
    assert jumps == [(day(2020, 1, 3), p) for p in ("avg", "max", "min")] + [(day(2020, 1, 4), p) for p in ("avg", "max")]


def test_v1_profile_without_valid_values(spark):
    data = [(1, "A", datetime.date(2020, 1, 1), 51.0, 0.0, -9999.0, 70.0, -9999.0, "909")]
    profile = R.v1_statistics(v1(spark, data)).first()
    assert (profile.min_temp, profile.min_temp_place) == (None, "No valid measurements")
    assert profile.max_temp_place == "No valid measurements" and profile.avg_temp is None


def test_combined_reports(spark):
    totals = spark.createDataFrame([(0, 5, 1), (1, 7, 2)], "archive_ord int, total_records long, valid_records long")
    assert tuple(I.combine_totals(totals).first()) == (12, 3)
    stats = spark.createDataFrame([(0, 1, 5), (1, 1, 7), (0, 2, 3)], "archive_ord int, station_id int, total_records long")
    assert rows(I.combine_station_statistics(stats)) == [(1, 7), (2, 3)]


def test_extreme_events_need_all_gradings(spark):
    day = datetime.date(2020, 1, 1)
    data = [
        (1, "A", day, 50.0, 0.0, 1.0, 36.0, None, 1.0, 1.0, "0", "0", "0"),
        (2, "B", day, 50.0, 0.0, 1.0, 36.0, None, None, 1.0, "0", None, "0"),  # no grading of rain
    ]
    assert rows(D.extreme_events(weather(spark, data)), "station_name") == [("A",)]


def test_neighbours_against_all_pairs(spark):
    r = random.Random(7)
    points = [(i, r.uniform(-89.9, 89.9), r.uniform(-180, 180)) for i in range(250)]
    points += [(1000, 10.0, 179.95), (1001, 10.0, -179.95), (1002, 89.9, 0.0), (1003, 89.9, 180.0), (1004, 0.0, 0.0), (1005, 0.01, 0.01)]
    df = spark.createDataFrame(points, "station_id int, latitude double, longitude double")
    from math import asin, cos, radians, sin, sqrt

    def km(a, b):
        la, lb = radians(a[1]), radians(b[1])
        h = sin((lb - la) / 2) ** 2 + cos(la) * cos(lb) * sin(radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6371.0 * asin(sqrt(h))

    for radius in (25.0, 600.0):
        expected = sorted((a[0], b[0]) for i, a in enumerate(points) for b in points[i + 1 :] if km(a, b) <= radius)
        got = sorted((x.station_id, x.other_id) for x in NB.station_neighbours(df, radius).collect())
        assert got == expected


def test_batch_hook(spark):
    df = spark.range(1000)
    got = process_in_batches(df, lambda b: b.assign(twice=b["id"] * 2)[["twice"]], "twice long")
    assert got.agg(F.sum("twice")).first()[0] == 999000

    def broken(batch):
        raise ValueError("refused")

    with pytest.raises(Exception, match="refused"):
        process_in_batches(df, broken, "id long").count()


def test_unlisted_elements_skip_archives_without_list(spark):
    files = spark.createDataFrame([("a", "TN", 1), ("a", "TX", 1), ("b", "TN", 1)], "archive string, element string, files int")
    listed = spark.createDataFrame([("a", "TN")], "archive string, element string")
    assert rows(C.unlisted_elements(files, listed)) == [("a", "TX")]


def test_reports_from_one_scan(spark):
    records = weather(spark, random_weather(5, 400)).withColumn("archive_ord", F.col("station_id") % 2)
    for keys in ((), ("archive_ord",)):
        state = I.report_state(records, *keys)
        assert rows(I.totals_of_state(state, *keys)) == rows(I.integrity_totals(records, *keys))
        one, other = I.station_statistics_of_state(state, *keys), I.station_statistics(records, *keys)
        assert one.columns == other.columns
        rounded = [c.withColumn("avg_temp", F.round("avg_temp", 9)) for c in (one, other)]
        assert rows(rounded[0]) == rows(rounded[1])
    assert rows(I.totals_of_state(I.report_state(records.limit(0)))) == rows(I.integrity_totals(records.limit(0)))
