"""Integrity reports on wide records and on the nine-column layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import schemas as S
from ..functions import geo as G
from ..functions import quality as Q
from ..schemas import f32


def _count(condition: Column) -> Column:
    return F.count_if(condition)


# --- wide records ------------------------------------------------------------------------------


def integrity_totals(records: DataFrame, *keys: str) -> DataFrame:
    """Counts of records; valid, suspect and missing exclude each other in this order."""
    valid = Q.temperature_flag_valid() & Q.precipitation_flag_valid() & Q.wind_flag_valid()
    suspect, missing = Q.has_suspect_flag(), Q.has_missing_flag()
    return records.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_records"),
        _count(valid).alias("valid_records"),
        _count(~valid & suspect).alias("suspect_records"),
        _count(~valid & ~suspect & missing).alias("missing_data_records"),
        _count(Q.record_violation().isNotNull()).alias("invalid_records"),
    )


def violations(records: DataFrame, *keys: str) -> DataFrame:
    """The first broken rule of each record that breaks one, with the values involved."""
    return records.withColumn("violation", Q.record_violation()).filter(
        F.col("violation").isNotNull()
    ).select(*keys, "station_id", "date", "violation", *S.WEATHER_VALUES)


def station_statistics(records: DataFrame, *keys: str) -> DataFrame:
    valid = Q.temperature_flag_valid()
    suspect, missing = Q.has_suspect_flag(), Q.has_missing_flag()
    return records.groupBy(*keys, "station_id").agg(
        F.count(F.lit(1)).alias("total_records"),
        _count(valid).alias("valid_records"),
        _count(~valid & suspect).alias("suspect_records"),
        _count(~valid & ~suspect & missing).alias("missing_data_records"),
        F.min("temp_min").alias("min_temp"),
        F.max("temp_max").alias("max_temp"),
        F.avg(F.col("temp_avg").cast("double")).alias("avg_temp"),
    )


_COUNTS = ("total", "valid", "suspect", "missing_data", "invalid")


def report_state(records: DataFrame, *keys: str) -> DataFrame:
    """What the totals and the station statistics of a report are made of, per station, in one scan."""
    temperature = Q.temperature_flag_valid()
    valid = temperature & Q.precipitation_flag_valid() & Q.wind_flag_valid()
    suspect, missing = Q.has_suspect_flag(), Q.has_missing_flag()
    flags = {"": valid, "temp_": temperature}
    counts = [
        c
        for head, good in flags.items()
        for c in (
            _count(good).alias(f"{head}valid_records"),
            _count(~good & suspect).alias(f"{head}suspect_records"),
            _count(~good & ~suspect & missing).alias(f"{head}missing_data_records"),
        )
    ]
    return records.groupBy(*keys, "station_id").agg(
        F.count(F.lit(1)).alias("total_records"),
        *counts,
        _count(Q.record_violation().isNotNull()).alias("invalid_records"),
        F.min("temp_min").alias("min_temp"),
        F.max("temp_max").alias("max_temp"),
        F.sum(F.col("temp_avg").cast("double")).alias("avg_sum"),
        F.count("temp_avg").alias("avg_n"),
    )


def totals_of_state(state: DataFrame, *keys: str) -> DataFrame:
    """`integrity_totals` from `report_state`."""
    return state.groupBy(*keys).agg(*[F.coalesce(F.sum(f"{c}_records"), F.lit(0)).alias(f"{c}_records") for c in _COUNTS])


def station_statistics_of_state(state: DataFrame, *keys: str) -> DataFrame:
    """`station_statistics` from `report_state`."""
    counts = [F.col(f"temp_{c}_records").alias(f"{c}_records") for c in _COUNTS[1:4]]
    mean = F.when(F.col("avg_n") > 0, F.col("avg_sum") / F.col("avg_n")).alias("avg_temp")
    return state.select(*keys, "station_id", "total_records", *counts, "min_temp", "max_temp", mean)


def combine_totals(per_archive: DataFrame) -> DataFrame:
    """Totals of several archives added up."""
    names = [c for c in per_archive.columns if c.endswith("_records")]
    return per_archive.agg(*[F.sum(c).alias(c) for c in names])


def combine_station_statistics(per_archive: DataFrame) -> DataFrame:
    """Of several archives with the same station, the last archive's row stays."""
    row = F.struct(*[c for c in per_archive.columns if c not in ("archive_ord", "station_id")])
    return (
        per_archive.groupBy("station_id")
        .agg(F.max_by(row, "archive_ord").alias("s"))
        .select("station_id", "s.*")
    )


def first_violations(found: DataFrame, n: int = 10) -> DataFrame:
    return found.orderBy("station_id", "date", "violation").limit(n)


def summary_percentages(totals: DataFrame) -> DataFrame:
    whole = F.col("total_records")
    return totals.select(
        "*",
        *[
            G.percent(F.col(f"{k}_records"), whole).alias(f"{k}_percent")
            for k in ("valid", "suspect", "invalid")
        ],
    )


# --- nine-column layout ------------------------------------------------------------------------


def v1_totals(records: DataFrame) -> DataFrame:
    """Valid, else suspect, else invalid; missing is counted on its own."""
    valid, suspect = Q.v1_valid(), Q.v1_suspect()
    return records.agg(
        F.count(F.lit(1)).alias("total_records"),
        _count(valid).alias("valid_records"),
        _count(~valid & suspect).alias("suspect_records"),
        _count(~valid & ~suspect).alias("invalid_records"),
        _count(Q.v1_missing()).alias("missing_data_records"),
    )


V1_VALUES = [("min", "min_temp"), ("max", "max_temp"), ("avg", "avg_temp")]


def _one_row_per_value(records: DataFrame, *more: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("part"), F.col(c).alias("value")) for n, c in V1_VALUES])
    return records.select("station_id", "date", *more, F.inline(pairs))


def v1_range_violations(records: DataFrame) -> DataFrame:
    """One row per present value outside the accepted range."""
    value = F.col("value")
    absent = f32(S.MISSING_V1)
    return (
        _one_row_per_value(records)
        .filter((value != absent) & ~value.between(*map(f32, S.TEMP_RANGE)))
        .select("station_id", "date", F.lit("OutOfRange").alias("violation"), "part", "value")
    )


def v1_relation_violations(records: DataFrame, parity: bool = False) -> DataFrame:
    """Order breaks per record.

    With `parity` every failed check, absent values included, is reported under the first name as
    the older checker does. By default absent values are left out and the cause is named; range
    breaks come from `v1_range_violations` alone.
    """
    none = F.lit(None).cast("string"), F.lit(None).cast("float")
    if parity:
        broken = records.filter(Q.v1_violation().isNotNull())
        name: Column = F.lit("MinGreaterThanAvg")
    else:
        low, mid, high = (
            F.nullif(F.col(c), f32(S.MISSING_V1)) for c in ("min_temp", "avg_temp", "max_temp")
        )
        name = Q.order_break(low, mid, high, S.ORDER_TOLERANCE)
        broken = records.filter(name.isNotNull())
    return broken.select(
        "station_id", "date", name.alias("violation"), none[0].alias("part"), none[1].alias("value")
    )


def v1_station_statistics(records: DataFrame, parity: bool = False) -> DataFrame:
    """Per-station counts and extremes.

    With `parity` the maximum is taken over minimum temperatures and the mean stays empty, as the
    older checker does.
    """
    absent = f32(S.MISSING_V1)
    valid, suspect = Q.v1_valid(), Q.v1_suspect()
    low, high, mid = (F.nullif(F.col(c), absent) for c in ("min_temp", "max_temp", "avg_temp"))
    return records.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("total_records"),
        _count(valid).alias("valid_records"),
        _count(~valid & suspect).alias("suspect_records"),
        _count(Q.v1_missing()).alias("missing_data_records"),
        F.min(low).alias("min_temp"),
        F.max(low if parity else high).alias("max_temp"),
        (F.lit(None).cast("double") if parity else F.avg(mid.cast("double"))).alias("avg_temp"),
    )


# --- jumps between consecutive records ---------------------------------------------------------


def suspicious_jumps(
    records: DataFrame, columns: dict[str, str], limit: float = S.JUMP_LIMIT, absent: float | None = None
) -> DataFrame:
    """Values that differ by more than `limit` from the station's previous record.

    `columns` maps part names to columns. The window runs per station and year, at most 366 records
    of a merged table, so a station with most of the data is spread like any other. The last
    record of each earlier year is handed to the next one through a small station-year table.
    """
    values = {
        name: F.col(c) if absent is None else F.nullif(F.col(c), f32(absent)) for name, c in columns.items()
    }
    narrow = records.select(
        "station_id", "date", F.year("date").alias("_year"), *[v.alias(n) for n, v in values.items()]
    ).repartition("station_id", "_year")
    row = F.struct("date", *values)
    ends = narrow.groupBy("station_id", "_year").agg(
        F.max("date").alias("_date"), *[F.max_by(n, "date").alias(n) for n in values]
    )
    handed = ends.select(
        "station_id",
        "_year",
        F.lag(F.struct(F.col("_date").alias("date"), *values)).over(W.partitionBy("station_id").orderBy("_year")).alias("_handed"),
    )
    within = W.partitionBy("station_id", "_year").orderBy("date")
    paired = narrow.withColumn("_prev", F.lag(row).over(within)).join(handed, ["station_id", "_year"])
    before = F.coalesce("_prev", "_handed")
    jumps = F.array(
        *[
            F.struct(
                F.lit(n).alias("part"),
                before["date"].alias("previous_date"),
                before[n].alias("previous_value"),
                F.col(n).alias("value"),
                F.abs(F.col(n) - before[n]).alias("jump"),
            )
            for n in values
        ]
    )
    return (
        paired.filter(before.isNotNull())
        .select("station_id", "date", F.inline(jumps))
        .filter(F.col("jump") > f32(limit))
    )


def weather_jumps(records: DataFrame, limit: float = S.JUMP_LIMIT) -> DataFrame:
    return suspicious_jumps(records, {"min": "temp_min", "max": "temp_max", "avg": "temp_avg"}, limit)


def v1_jumps(records: DataFrame, limit: float = S.JUMP_LIMIT) -> DataFrame:
    return suspicious_jumps(records, dict(V1_VALUES), limit, S.MISSING_V1)


# --- jumps kept per station and year -------------------------------------------------------------

_PARTS = {"min": "temp_min", "max": "temp_max", "avg": "temp_avg"}
JUMP_STATE = (
    "kind string, station_id long, date date, part string, previous_date date, previous_value float, value float, jump float, "
    "temp_min float, temp_max float, temp_avg float"
)


def _kind(name: str, rows: DataFrame) -> DataFrame:
    """The rows with all columns of the state; what they lack is NULL."""
    columns = [c.split() for c in JUMP_STATE.split(", ")]
    return rows.withColumn("kind", F.lit(name)).select(*[F.col(c) if c == "kind" or c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in columns])


def jump_state(records: DataFrame, limit: float = S.JUMP_LIMIT) -> DataFrame:
    """Jumps between records of one station and year, and each station-year's first and last record.

    `records` holds whole station-years. What follows over years is in `jumps_of_state`.
    """
    narrow = records.select("station_id", "date", F.year("date").alias("_year"), *_PARTS.values())
    keys, row = ("station_id", "_year"), F.struct("date", *_PARTS.values())
    within = W.partitionBy(*keys).orderBy("date")
    paired = narrow.withColumn("_prev", F.lag(row).over(within))
    jumps = paired.where(F.col("_prev").isNotNull()).select("station_id", "date", _jump_rows("_prev", limit)).select("station_id", "date", F.inline("j"))
    ends = narrow.groupBy(*keys).agg(F.min(row).alias("first"), F.max(row).alias("last"))
    first, last = (ends.select("station_id", f"{c}.*") for c in ("first", "last"))
    return _kind("jump", jumps).unionAll(_kind("first", first)).unionAll(_kind("last", last))


def _jump_rows(before: str, limit: float) -> Column:
    pairs = F.array(
        *[
            F.struct(
                F.lit(part).alias("part"),
                F.col(before)["date"].alias("previous_date"),
                F.col(before)[c].alias("previous_value"),
                F.col(c).alias("value"),
                F.abs(F.col(c) - F.col(before)[c]).alias("jump"),
            )
            for part, c in _PARTS.items()
        ]
    )
    return F.filter(pairs, lambda p: p["jump"] > f32(limit)).alias("j")


def jumps_of_state(state: DataFrame, limit: float = S.JUMP_LIMIT) -> DataFrame:
    """`weather_jumps` from `jump_state`: the stored rows, and pairs of a year's last and the next one's first record."""
    row = F.struct("date", *_PARTS.values())
    first, last = (state.where(F.col("kind") == k).withColumn("_year", F.year("date")) for k in ("first", "last"))
    # a row per station and year that has records
    earlier = last.select("station_id", "_year", F.lag(row).over(W.partitionBy("station_id").orderBy("_year")).alias("_prev"))
    paired = first.join(earlier.where("_prev is not null"), ["station_id", "_year"])
    over = paired.select("station_id", "date", _jump_rows("_prev", limit)).select("station_id", "date", F.inline("j"))
    within = state.where("kind = 'jump'").select("station_id", "date", "part", "previous_date", "previous_value", "value", "jump")
    return within.unionByName(over)
