"""Long observations to one wide record per station and day.

One aggregate does the pivot and the merge of archives. All its buffers are fixed-width, so it runs
as a hash aggregate with map-side partial aggregation and one exchange on (station, day); a hot key
is reduced before it is shuffled. Order questions ("the last row wins", "in the order first seen")
are answered by one BIGINT that packs archive number and processing order.

Where keys hardly repeat, the aggregate holds about a group per row, and a task as many as its input
has. If the number of rows is known (`rows`), they are dealt by key to a number of tasks that grows
with it, and a task's groups stay within TASK_ROWS or so.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S
from ..functions import quality as Q
from ..schemas import f32
from ..tuning import join_hint

QUALITY_MODES = ("compact", "positional")
TASK_ROWS = 1 << 19


def _dealt(df: DataFrame, rows: int | None, *keys: str) -> DataFrame:
    """`df` dealt by `keys` to the tasks that so many rows need; as it is if their number isn't known."""
    if rows is None:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


def _station_hint(stations: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A broadcast, or a join that hashes a task's few stations and sorts none of its many rows."""
    return join_hint(stations, larger="shuffle_hash")


def _first_seen_text(marks: dict[str, Column], bits: int) -> Column:
    """Flags of the last archive in the order first seen there.

    Each mark is `archive number << bits | (top - position)`, so the larger mark of one archive was
    seen earlier. There are three legal temperature flags, hence three marks.
    """
    last = F.shiftright(F.greatest(*marks.values()), bits)
    a, b, c = (F.when(F.shiftright(m, bits) == last, m) for m in marks.values())

    def digit(mark: Column) -> Column:
        chain = F.when(mark == a, list(marks)[0]).when(mark == b, list(marks)[1])
        return chain.when(mark == c, list(marks)[2])

    first, final = F.greatest(a, b, c), F.least(a, b, c)
    middle = F.greatest(F.least(a, b), F.least(F.greatest(a, b), c))
    three = a.isNotNull() & b.isNotNull() & c.isNotNull()
    return F.concat(
        digit(first),
        F.when(three, digit(middle)).otherwise(""),
        F.when(final != first, digit(final)).otherwise(""),
    )


def pivot_observations(
    obs: DataFrame,
    per_archive: bool = False,
    quality_mode: str = "compact",
    seq_bits: int = S.SEQ_BITS,
    rows: int | None = None,
) -> DataFrame:
    """One row per (station, day), or per (archive, station, day) with `per_archive`.

    Needs archive_ord, station_id, obs_date, element, value, qflag and seq. Per column the last
    value wins: last archive, then last processed row. Temperature flags are, in `compact` mode,
    the distinct flags of the last archive with temperatures, in the order first seen; in
    `positional` mode one digit per minimum, mean and maximum, 9 where the value is absent.
    `first_archive` is the number of the first archive with a row for the key. `rows` is about the
    number of rows of `obs`, if known.
    """
    if quality_mode not in QUALITY_MODES:
        raise ValueError(f"unknown quality mode: {quality_mode}")
    element, flag = F.col("element"), F.col("qflag")
    number = F.shiftleft(F.col("archive_ord").cast("long"), seq_bits)
    order = number + F.col("seq")
    seen = number + (F.lit(2**seq_bits - 1) - F.col("seq"))

    def last(column: str, prefix: str) -> Column:
        return F.max_by(column, F.when(element == prefix, order))

    aggs = [last("value", prefix).alias(column) for prefix, column, *_ in S.ELEMENTS]
    aggs += [last("qflag", "RR").alias("_rr"), last("qflag", "FG").alias("_fg")]
    if quality_mode == "compact":
        is_temp = element.isin(S.TEMPERATURE_PREFIXES)
        aggs += [F.max(F.when(is_temp & (flag == f), seen)).alias(f"_m{f}") for f in S.FLAGS]
        temp_quality = _first_seen_text({str(f): F.col(f"_m{f}") for f in S.FLAGS}, seq_bits)
    else:
        aggs += [last("qflag", p).alias(f"_{p}") for p in S.TEMPERATURE_PREFIXES]
        temp_quality = F.when(
            Q.has_temperature(),
            Q.positional_flags(F.col("_TN"), F.col("_TG"), F.col("_TX")),
        )
    keys = ["archive_ord"] if per_archive else []
    if not per_archive:
        aggs.append(F.min("archive_ord").alias("first_archive"))
    keyed = [*keys, "station_id", "obs_date"]
    wide = _dealt(obs, rows, *keyed).groupBy(*keyed).agg(*aggs)
    return wide.select(
        *(keys or ["first_archive"]),
        "station_id",
        F.col("obs_date").alias("date"),
        *S.WEATHER_VALUES,
        temp_quality.alias("temp_quality"),
        F.col("_rr").cast("string").alias("precip_quality"),
        F.col("_fg").cast("string").alias("wind_quality"),
    )


def keep_known_stations(
    obs: DataFrame, stations: DataFrame, *archive_key: str, hint=None, rows: int | None = None
) -> DataFrame:
    """Observations whose station is in the station list (of the same archive, if so keyed).

    Unless the list is broadcast they come dealt by station, to the tasks that `rows` rows need.
    """
    keys = [*archive_key, "station_id"]
    hint = hint or _station_hint(stations)
    if hint is not F.broadcast:
        obs = _dealt(obs, rows, *keys)
    return obs.join(hint(stations.select(*keys)), keys, "left_semi")


def unknown_stations(obs: DataFrame, stations: DataFrame, *archive_key: str) -> DataFrame:
    """Stations with observations but without metadata, and what is lost with them."""
    keys = [*archive_key, "station_id"]
    counts = obs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observations"), F.countDistinct("element").alias("elements")
    )
    return counts.join(stations.select(*keys), keys, "left_anti")


def attach_station(
    records: DataFrame, stations: DataFrame, archive_column: str | None = None, hint=None
) -> DataFrame:
    """Name and coordinates; joined after the pivot, so no text goes through its shuffle."""
    attributes = ["station_name", "latitude", "longitude"]
    hint = hint or _station_hint(stations)
    if archive_column:
        place = stations.select(F.col("archive_ord").alias(archive_column), "station_id", *attributes)
        return records.join(hint(place), [archive_column, "station_id"])
    return records.join(hint(stations.select("station_id", *attributes)), "station_id")


def to_weather(records: DataFrame, *extra: str) -> DataFrame:
    """Grade the values and bring the columns into table order."""
    return Q.with_physical_validity(records).select(*extra, *S.WEATHER_COLUMNS)


def archive_records(
    obs: DataFrame,
    stations: DataFrame,
    quality_mode: str = "compact",
    seq_bits: int = S.SEQ_BITS,
    all_known: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Records of each archive on its own, with `archive_ord` in front.

    `all_known` says that `obs` holds stations of the list only, as the readers leave it.
    """
    hint = _station_hint(stations)
    if not all_known:
        obs = keep_known_stations(obs, stations, "archive_ord", hint=hint, rows=rows)
        rows = rows if hint is F.broadcast else None  # dealt already
    wide = pivot_observations(obs, True, quality_mode, seq_bits, rows)
    return to_weather(attach_station(wide, stations, "archive_ord", hint), "archive_ord")


def unified_records(
    obs: DataFrame,
    stations: DataFrame,
    quality_mode: str = "compact",
    seq_bits: int = S.SEQ_BITS,
    rows: int | None = None,
) -> DataFrame:
    """Records over all archives: the last archive's value wins, the first one names the station."""
    hint = _station_hint(stations)
    known = keep_known_stations(obs, stations, "archive_ord", hint=hint)
    wide = pivot_observations(known, False, quality_mode, seq_bits, rows)
    return to_weather(attach_station(wide, stations, "first_archive", hint))


def single_source_records(
    obs: DataFrame,
    stations: DataFrame,
    quality_mode: str = "compact",
    seq_bits: int = S.SEQ_BITS,
    rows: int | None = None,
) -> DataFrame:
    """Records of one source whose station list has no archive column."""
    hint = _station_hint(stations)
    known = keep_known_stations(obs.withColumn("archive_ord", F.lit(0)), stations, hint=hint)
    wide = pivot_observations(known, False, quality_mode, seq_bits, rows)
    return to_weather(attach_station(wide, stations, hint=hint))


def merge_records(
    records: DataFrame,
    quality_mode: str = "compact",
    stations: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Merge finished per-archive records on (station, day), for archives stored as tables.

    Per column the last archive with a value wins and the values are graded again. Flag text is
    carried as a number (a leading 1 keeps its zeros) to stay in a hash aggregate. In positional
    mode each flag digit follows its own value. `stations` has the places by archive and station; if
    it isn't at hand they are taken from the records, which costs a pass over them. `rows` is about
    the number of records, if known.
    """
    order = F.col("archive_ord")

    def last(value: Column, present: Column) -> Column:
        return F.max_by(value, F.when(present.isNotNull(), order))

    def coded(text: Column) -> Column:
        return F.concat(F.lit("1"), text).cast("int")

    def decoded(name: str) -> Column:
        return F.substring(F.col(name).cast("string"), 2, 9)

    aggs = [last(F.col(c), F.col(c)).alias(c) for c in S.WEATHER_VALUES]
    aggs += [
        last(coded(F.col(q)), F.col(q)).alias(f"_{q}") for q in ("precip_quality", "wind_quality")
    ]
    if quality_mode == "compact":
        temp = F.col("temp_quality")
        aggs.append(last(coded(temp), temp).alias("_temp_quality"))
        temp_quality = decoded("_temp_quality")
    else:
        for i, value in enumerate(("temp_min", "temp_avg", "temp_max"), 1):
            digit = F.substring("temp_quality", i, 1).cast("int")
            aggs.append(last(digit, F.col(value)).alias(f"_q{i}"))
        temp_quality = F.when(
            Q.has_temperature(), Q.positional_flags(F.col("_q1"), F.col("_q2"), F.col("_q3"))
        )
    aggs.append(F.min(order).alias("first_archive"))
    merged = _dealt(records, rows, "station_id", "date").groupBy("station_id", "date").agg(*aggs)
    merged = merged.withColumns(
        {
            "temp_quality": temp_quality,
            "precip_quality": decoded("_precip_quality"),
            "wind_quality": decoded("_wind_quality"),
        }
    )
    columns = ("archive_ord", "station_id", "station_name", "latitude", "longitude")
    places = records.select(*columns).distinct() if stations is None else stations.select(*columns)
    return to_weather(attach_station(merged, places, "first_archive"))


def consolidated_records(
    obs: DataFrame,
    stations: DataFrame,
    allow_incomplete: bool = False,
    seq_bits: int = S.SEQ_BITS,
    rows: int | None = None,
) -> DataFrame:
    """The nine-column layout: complete temperature triples, or -9999 and flag 9 for what is absent."""
    temps = obs.filter(F.col("element").isin(S.TEMPERATURE_PREFIXES))
    hint = _station_hint(stations)
    known = keep_known_stations(temps.withColumn("archive_ord", F.lit(0)), stations, hint=hint)
    wide = pivot_observations(known, False, "positional", seq_bits, rows)
    wide = wide.filter(Q.has_temperature() if allow_incomplete else Q.has_complete_temperature())
    absent = f32(S.MISSING_V1)
    return (
        attach_station(wide, stations, hint=hint)
        .select(
            "station_id",
            "station_name",
            "date",
            "latitude",
            "longitude",
            F.coalesce("temp_min", absent).alias("min_temp"),
            F.coalesce("temp_max", absent).alias("max_temp"),
            F.coalesce("temp_avg", absent).alias("avg_temp"),
            F.col("temp_quality").alias("quality_flags"),
        )
        # a stored value of -9999 counts as absent too
        .filter(
            (F.col("min_temp") != absent) | (F.col("max_temp") != absent) | (F.col("avg_temp") != absent)
        )
    )
