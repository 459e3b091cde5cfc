"""Profile of a stored dataset: coverage, quality counts, extremes and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import schemas as S
from ..functions import geo as G
from ..functions import quality as Q
from ..schemas import f32

_PRESENT = {
    "temperature": Q.has_temperature,
    "precipitation": Q.has_precipitation,
    "wind_speed": Q.has_wind,
}
_QUALITY = {
    "temperature": Q.temperature_quality,
    "precipitation": Q.precipitation_quality,
    "wind_speed": Q.wind_quality,
}


def composition(records: DataFrame) -> DataFrame:
    """How many records carry each metric, their shares, and the metrics that occur at all."""
    counts = records.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(test()).alias(f"records_with_{m}") for m, test in _PRESENT.items()],
    )
    return counts.select(
        "*",
        *[
            G.percent(F.col(f"records_with_{m}"), F.col("total_records")).alias(f"{m}_percent")
            for m in S.METRICS
        ],
        F.concat_ws(
            ",", *[F.when(F.col(f"records_with_{m}") > 0, F.lit(m)) for m in S.METRICS]
        ).alias("available_metrics"),
    )


# --- one scan for bounds, coverage and quality counts --------------------------------------------


def station_profile(records: DataFrame) -> DataFrame:
    """Partial profile per station. Everything below adds these rows up, so a dataset is scanned
    once and distinct stations need no distinct aggregation. Store it to use it more than once."""
    return _graded(records).groupBy("station_id").agg(*_partials())


def _graded(records: DataFrame) -> DataFrame:
    return records.withColumns({f"_{m}": quality() for m, quality in _QUALITY.items()})


def _partials() -> list[Column]:
    """Counts and bounds that can be added up."""
    counts = {k: c for family in (_flag_counts(), _validity_counts(), _quality_counts()) for k, c in family.items()}
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
    ]
    for metric, test in _PRESENT.items():
        present = test()
        usable = present & (F.col(f"_{metric}") != "Invalid")
        low, high = {
            "temperature": ("temp_min", "temp_max"),
            "precipitation": ("precipitation",) * 2,
            "wind_speed": ("wind_speed",) * 2,
        }[metric]
        aggs += [
            F.count_if(present).alias(f"{metric}_n"),
            F.min(F.when(present, F.col("date"))).alias(f"{metric}_first"),
            F.max(F.when(present, F.col("date"))).alias(f"{metric}_last"),
            F.min(F.when(usable, F.col(low))).alias(f"{metric}_low"),
            F.max(F.when(usable, F.col(high))).alias(f"{metric}_high"),
        ]
    return [*aggs, *[c.alias(k) for k, c in counts.items()]]


# Sketches of distinct stations have 2 ** SKETCH_BITS registers: a standard error of 1.04 / sqrt(2 ** 14), 0.8 %.
SKETCH_BITS = 14


def file_profile(records: DataFrame, file: Column) -> DataFrame:
    """Partial profile per data file. Stations reach over files, so a file holds sketches of its
    stations, of all and per metric, which can be united; everything else adds up exactly."""
    sketches = [F.hll_sketch_agg("station_id", SKETCH_BITS).alias("stations")]
    sketches += [F.hll_sketch_agg(F.when(test(), F.col("station_id")), SKETCH_BITS).alias(f"{m}_stations") for m, test in _PRESENT.items()]
    return _graded(records).groupBy(file.alias("file")).agg(*_partials(), *sketches)


def _distinct_stations(sketch: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0))


def dataset_bounds(stations: DataFrame) -> DataFrame:
    """Rows, stations, dates and coordinates of the dataset, from `station_profile`.

    From `file_profile` the number of stations is an estimate.
    """
    number = _distinct_stations("stations") if "stations" in stations.columns else F.count(F.lit(1))
    total = stations.agg(
        F.sum("n").alias("total_records"),
        number.alias("total_stations"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.min("min_lat").alias("min_lat"),
        F.max("max_lat").alias("max_lat"),
        F.min("min_lon").alias("min_lon"),
        F.max("max_lon").alias("max_lon"),
    )
    return total.select(
        "*",
        G.years_by_calendar(F.col("first_date"), F.col("last_date")).alias("years"),
        G.guess_countries(F.col("min_lon"), F.col("max_lat")).alias("countries"),
    )


def metric_coverage(stations: DataFrame) -> DataFrame:
    """Rows, stations, share, dates and value range per metric, from `station_profile`.

    Amounts range from zero. The temperature range needs both a minimum and a maximum. From
    `file_profile` the numbers of stations are estimates.
    """
    sketched = "stations" in stations.columns
    per_metric = []
    for m in S.METRICS:
        low = F.col(f"{m}_low") if m == "temperature" else F.when(F.col(f"{m}_high").isNotNull(), f32(0.0))
        per_metric.append(
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"{m}_n").alias("n"),
                F.col(f"{m}_first").alias("first_date"),
                F.col(f"{m}_last").alias("last_date"),
                low.alias("low"),
                F.col(f"{m}_high").alias("high"),
                *[F.col(f"{m}_stations").alias("sketch")] * sketched,
            )
        )
    long = stations.select(F.col("n").alias("station_n"), F.inline(F.array(*per_metric)))
    out = long.groupBy("metric").agg(
        (_distinct_stations("sketch") if sketched else F.count_if(F.col("n") > 0)).alias("stations"),
        F.sum("n").alias("records"),
        G.percent(F.sum("n"), F.sum("station_n")).alias("coverage_percent"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.min("low").alias("low_value"),
        F.max("high").alias("high_value"),
    )
    both = F.col("low_value").isNotNull() & F.col("high_value").isNotNull()
    return out.withColumns(
        {"low_value": F.when(both, F.col("low_value")), "high_value": F.when(both, F.col("high_value"))}
    )


def _sum_flags(conditions: list[Column]) -> Column:
    total = None
    for c in conditions:
        one = F.count_if(c)
        total = one if total is None else total + one
    return total


def _flag_counts() -> dict[str, Column]:
    temp, rain, wind = F.col("temp_quality"), F.col("precip_quality"), F.col("wind_quality")
    t = {
        "valid": temp.contains("0"),
        "suspect": ~temp.contains("0") & temp.contains("1"),
        "missing": ~temp.contains("0") & ~temp.contains("1") & temp.contains("9"),
    }
    digit = {"valid": "0", "suspect": "1", "missing": "9"}
    return {
        f"source_flag_{k}": _sum_flags(
            [
                Q.has_temperature() & t[k],
                Q.has_precipitation() & (rain == digit[k]),
                Q.has_wind() & (wind == digit[k]),
            ]
        )
        for k in digit
    }


def _validity_counts() -> dict[str, Column]:
    kinds = ("Valid", "Suspect", "Invalid")
    return {f"validity_{v}": _sum_flags([F.col(c) == v for c in S.VALIDATION_COLUMNS]) for v in kinds}


QUALITY_NAMES = ["Valid", "SuspectOriginal", "SuspectRange", "SuspectBoth", "Invalid", "Missing"]


def _quality_counts() -> dict[str, Column]:
    return {f"quality_{q}": _sum_flags([F.col(f"_{m}") == q for m in S.METRICS]) for q in QUALITY_NAMES}


def _long(stations: DataFrame, key: str) -> DataFrame:
    """Counts of one family, added up over the stations; (key, n) rows, those without hits with 0."""
    names = [c for c in stations.columns if c.startswith(f"{key}_")]
    one = stations.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    pairs = F.array(*[F.struct(F.lit(c.removeprefix(f"{key}_")).alias(key), F.col(c).alias("n")) for c in names])
    return one.select(F.inline(pairs))


def source_flag_counts(stations: DataFrame) -> DataFrame:
    """Source flags over the metrics present, from `station_profile`; temperature text is tested for
    0, then 1, then 9."""
    return _long(stations, "source_flag")


def physical_validity_counts(stations: DataFrame) -> DataFrame:
    """Values by physical validity, from `station_profile`."""
    return _long(stations, "validity")


def combined_quality_counts(stations: DataFrame) -> DataFrame:
    """Always three assessments per record, from `station_profile`; an absent metric counts as Valid."""
    return _long(stations, "quality")


# --- extremes ----------------------------------------------------------------------------------


def extreme_records(records: DataFrame) -> DataFrame:
    """Coldest, hottest, wettest and windiest record that is not Invalid; ties go to the first
    (station, day).

    One pass: the four winners are kept whole by an aggregate without keys.
    """
    sid, day, row = F.col("station_id"), F.unix_date("date"), F.struct(*S.WEATHER_COLUMNS).alias("row")

    def top(column: str, metric: str) -> Column:
        use = F.col(column).isNotNull() & (_QUALITY[metric]() != "Invalid")
        return F.max(F.when(use, F.struct(F.col(column).alias("v"), (-sid).alias("s"), (-day).alias("d"), row)))

    cold = F.col("temp_min").isNotNull() & (Q.temperature_quality() != "Invalid")
    winners = {
        "coldest": F.min(F.when(cold, F.struct(F.col("temp_min").alias("v"), sid.alias("s"), day.alias("d"), row))),
        "hottest": top("temp_max", "temperature"),
        "wettest": top("precipitation", "precipitation"),
        "windiest": top("wind_speed", "wind_speed"),
    }
    found = records.agg(*[c.alias(n) for n, c in winners.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("extreme"), F.col(n)["row"].alias("row")) for n in winners])
    return found.select(F.inline(pairs)).where(F.col("row").isNotNull()).select("extreme", "row.*")


# --- diverse sample ----------------------------------------------------------------------------


def _numbered_buckets(records: DataFrame) -> DataFrame:
    """(station, year) with its row count and the number of rows before it in (station, day) order.

    Running totals are taken in two steps over domains of known size: within groups of 4,096
    station numbers, one row per station and year, and over the at most 524,288 groups. No window
    sees the records.
    """
    years = records.groupBy("station_id", F.year("date").alias("_year")).agg(F.count(F.lit(1)).alias("_n"))
    years = years.withColumn("_group", F.shiftright("station_id", 12))

    def before(n: str, window) -> Column:
        return F.coalesce(F.sum(n).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    groups = years.groupBy("_group").agg(F.sum("_n").alias("_group_n"))
    groups = groups.select(
        "_group",
        before("_group_n", W.orderBy("_group")).alias("_g0"),
        F.sum("_group_n").over(W.partitionBy()).alias("_total"),
    )
    in_group = before("_n", W.partitionBy("_group").orderBy("station_id", "_year"))
    return (
        years.select("_group", "station_id", "_year", "_n", in_group.alias("_y0"))
        .join(F.broadcast(groups), "_group")
        .select("station_id", "_year", "_n", "_total", (F.col("_g0") + F.col("_y0")).alias("_start"))
    )


def diverse_sample(records: DataFrame, size: int) -> DataFrame:
    """About `size` records spread evenly over the table in (station, day) order.

    Every step-th row is a candidate, at most two per station name are taken; if they are too few,
    every second candidate not yet taken fills up. There are at most 75 candidates per sample row,
    and only the (station, year) buckets they fall into are numbered.
    """
    if size <= 0:
        return records.limit(0)
    total = F.col("_total")
    step = F.when(total > size * 100, F.floor(total / F.lit(size * 50))).otherwise(
        F.greatest(F.lit(1), F.floor(total / F.lit(size)))
    )
    buckets = _numbered_buckets(records).withColumn("_step", step)
    first_hit = F.ceil(F.col("_start") / F.col("_step")) * F.col("_step")
    hit = buckets.filter(first_hit < F.col("_start") + F.col("_n"))
    # at most 75 * size candidates, hence buckets
    chosen = records.withColumn("_year", F.year("date")).join(
        F.broadcast(hit.select("station_id", "_year", "_start", "_step")), ["station_id", "_year"]
    )
    index = F.col("_start") + F.row_number().over(W.partitionBy("station_id", "_year").orderBy("date")) - 1
    candidates = chosen.withColumn("_i", index).filter(F.col("_i") % F.col("_step") == 0)
    per_name = F.row_number().over(W.partitionBy("station_name").orderBy("_i"))
    # first the rows of the main pass in order, then the fill in order; a (name, day) counts once
    ranked = candidates.withColumn("_turn", per_name)
    main_rank = F.row_number().over(W.partitionBy(F.col("_turn") <= 2).orderBy("_i"))
    ranked = ranked.withColumn("_main", (F.col("_turn") <= 2) & (main_rank <= size))
    may_fill = F.col("_i") % (F.col("_step") * 2) == 0
    pool = ranked.filter(F.col("_main") | may_fill)
    once = F.row_number().over(
        W.partitionBy("station_name", "date").orderBy(F.col("_main").desc(), F.col("_i"))
    )
    return (
        pool.withColumn("_once", once)
        .filter(F.col("_main") | (F.col("_once") == 1))
        .orderBy(F.col("_main").desc(), "_i")
        .limit(size)
        .select(*S.WEATHER_COLUMNS)
    )


# --- nine-column layout ------------------------------------------------------------------------


def v1_statistics(records: DataFrame) -> DataFrame:
    """One-row profile: extremes with their place, mean of valid means, flag counts, bounds."""
    sid, day = F.col("station_id"), F.unix_date("date")

    # The places are found by their own aggregate without groups, so that the per-station one
    # holds numbers only and needs no sort.
    def key(column: str, sign: int) -> Column:
        use = Q.temperature_in_range(F.col(column))
        place = [F.concat("station_name", F.lit(" ("), F.col("date").cast("string"), F.lit(")")).alias("p")]
        parts = [F.col(column).alias("v"), (sign * sid).alias("s"), (sign * day).alias("d")]
        return F.when(use, F.struct(*parts, *place))

    one = records.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("d0"),
        F.max("date").alias("d1"),
        F.sum(F.when(Q.temperature_in_range(F.col("avg_temp")), F.col("avg_temp").cast("double"))).alias("s"),
        F.count_if(Q.temperature_in_range(F.col("avg_temp"))).alias("sn"),
        F.count_if(Q.v1_valid()).alias("valid"),
        F.count_if(Q.v1_suspect()).alias("suspect"),
        F.count_if(Q.v1_missing()).alias("missing"),
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
    )
    total = one.agg(
        F.sum("n").alias("total_records"),
        F.count(F.lit(1)).alias("unique_stations"),
        F.min("d0").alias("first_date"),
        F.max("d1").alias("last_date"),
        F.sum("s").alias("s"),
        F.sum("sn").alias("sn"),
        *[F.sum(k).alias(f"{k}_records") for k in ("valid", "suspect", "missing")],
        *[F.min(k).alias(k) for k in ("min_lat", "min_lon")],
        *[F.max(k).alias(k) for k in ("max_lat", "max_lon")],
    ).filter(F.col("total_records") > 0)
    places = records.agg(
        F.struct(F.min(key("min_temp", 1)).alias("lo"), F.max(key("max_temp", -1)).alias("hi")).alias("p")
    )
    total = total.select("*", places.scalar().alias("p")).select("*", "p.*")
    nothing = F.lit("No valid measurements")
    return total.select(
        "total_records",
        "unique_stations",
        "first_date",
        "last_date",
        G.years_by_days(F.col("first_date"), F.col("last_date")).alias("years"),
        F.col("lo.v").alias("min_temp"),
        F.coalesce("lo.p", nothing).alias("min_temp_place"),
        F.col("hi.v").alias("max_temp"),
        F.coalesce("hi.p", nothing).alias("max_temp_place"),
        (F.col("s") / F.nullif(F.col("sn"), F.lit(0))).alias("avg_temp"),
        "valid_records",
        "suspect_records",
        "missing_records",
        (F.col("total_records") - F.col("missing_records")).alias("complete_records"),
        *[
            G.percent(F.col(f"{k}_records"), F.col("total_records")).alias(f"{k}_percent")
            for k in ("valid", "suspect", "missing")
        ],
        "min_lat",
        "max_lat",
        "min_lon",
        "max_lon",
    )


# --- coverage report ---------------------------------------------------------------------------


def coverage_report(records: DataFrame) -> DataFrame:
    """Stations by the metrics they ever report; complete temperature means all three on one day."""
    per_station = records.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_or(Q.has_complete_temperature()).alias("complete"),
        *[F.bool_or(test()).alias(m) for m, test in _PRESENT.items()],
    )
    metrics = sum(F.col(m).cast("int") for m in S.METRICS)
    return per_station.agg(
        F.sum("n").alias("total_records"),
        F.count(F.lit(1)).alias("total_stations"),
        F.count_if("complete").alias("stations_with_complete_temperature"),
        F.count_if("temperature").alias("stations_with_any_temperature"),
        F.count_if("precipitation").alias("stations_with_precipitation"),
        F.count_if("wind_speed").alias("stations_with_wind"),
        F.count_if(metrics >= 2).alias("multi_metric_stations"),
    )
