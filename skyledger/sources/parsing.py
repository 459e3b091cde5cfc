"""Text lines to typed rows: observations, stations, elements. Pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from .. import schemas as S
from ..functions import text as X
from ..tuning import computed_once

TOP_U32 = 2**32 - 1


def parse_observation_lines(lines: DataFrame) -> DataFrame:
    """Adds source_id, obs_date, value, qflag and `defect` to lines of station files.

    Blank lines, lines with fewer than four fields and missing values leave no row. `defect` names
    what is wrong with a line. Temperature lines need a source id, a whole number and a flag of
    0, 1 or 9; other elements need a number and a flag from 0 to 255.
    """
    keep = [c for c in lines.columns if c != "line"]
    parts = F.col("_parts")
    names = ("_source", "_date", "_value", "_flag")
    fields = [X.field(parts, i, F.col("_plain")).alias(n) for i, n in enumerate(names)]
    raw = lines.select(
        *keep, F.split("line", ",", 5).alias("_parts"), X.is_plain(F.col("line")).alias("_plain")
    ).select(*keep, *fields)
    is_temp = F.col("element").isin(S.TEMPERATURE_PREFIXES)
    flag = X.to_unsigned(F.col("_flag"), 255).cast("int")
    typed = computed_once(
        raw,
        [*keep, *names],
        {
            "source_id": X.to_unsigned(F.col("_source"), TOP_U32),
            "obs_date": X.to_date(F.col("_date")),
            "value": F.when(is_temp, X.scale_tenths(X.to_int(F.col("_value")))).otherwise(
                X.scale_tenths(X.to_decimal(F.col("_value"), "float"))
            ),
            "qflag": F.when(~is_temp | flag.isin(S.FLAGS), flag),
        },
    )
    missing = F.col("_value") == S.MISSING_TEXT
    defect = (
        F.when(is_temp & F.col("source_id").isNull(), F.concat(F.lit("source id: "), "_source"))
        .when(F.col("obs_date").isNull(), F.concat(F.lit("date: "), "_date"))
        .when(missing, F.lit(None).cast("string"))
        .when(F.col("value").isNull(), F.concat(F.lit("value: "), "_value"))
        .when(F.col("qflag").isNull(), F.concat(F.lit("flag: "), "_flag"))
    )
    # One condition, so that no part of it is moved below the typing and repeats the splitting.
    short = F.col("_flag").isNull()
    keep_line = F.when(short, F.lit(False)).otherwise(F.col("defect").isNotNull() | ~missing)
    return typed.withColumn("defect", defect).filter(keep_line).drop(*names)


def line_dates(lines: DataFrame) -> DataFrame:
    """obs_date of every data line that has one, whether or not its value is usable."""
    keep = [c for c in lines.columns if c != "line"]
    second = X.strip(F.get(F.split("line", ",", 3), F.lit(1)))
    dated = computed_once(lines, keep, {"_date": second})
    return computed_once(dated, keep, {"obs_date": X.to_date(F.col("_date"))}).filter(
        F.col("obs_date").isNotNull()
    )


def good_observations(
    parsed: DataFrame,
    temperature_defects: str = "fail",
    other_defects: str = "drop",
    known: Column | None = None,
) -> DataFrame:
    """Rows without a defect. A defect fails the job or drops the line, set per kind of element.

    Rows where `known` is not true are dropped first and never fail the job. The test stands in
    the same expression, so the optimizer cannot move one before the other.
    """
    for choice in (temperature_defects, other_defects):
        if choice not in ("fail", "drop"):
            raise ValueError(f"unknown choice for defects: {choice}")
    is_temp = F.col("element").isin(S.TEMPERATURE_PREFIXES)
    fatal = F.lit(False)
    if temperature_defects == "fail":
        fatal = fatal | is_temp
    if other_defects == "fail":
        fatal = fatal | ~is_temp
    bad = F.col("defect").isNotNull()
    text = F.concat(F.lit("station "), F.col("station_id").cast("string"), F.lit(", bad "), "defect")
    known = F.lit(True) if known is None else F.coalesce(known, F.lit(False))
    keep = F.when(~known, F.lit(False)).when(bad & fatal, F.raise_error(text).cast("boolean"))
    keep = keep.otherwise(~bad)
    return parsed.filter(keep).drop("defect")


DEFECTS = ("source id", "date", "value", "flag")


def observed_lines(parsed: DataFrame, observation: Observation) -> DataFrame:
    """Counts rows and defects per kind in whatever pass reads `parsed` first: `observation.get` has
    `observations` and `defect_<kind>`. Work that is done again after a lost executor counts again."""
    kinds = [F.count_if(F.startswith("defect", F.lit(f"{kind}: "))).alias(f"defect_{kind.replace(' ', '_')}") for kind in DEFECTS]
    return parsed.observe(observation, F.count_if(F.col("defect").isNull()).alias("observations"), *kinds)


def defective_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("defect").isNotNull())


def parse_station_lines(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Station rows of `stations.txt` lines; keeps every other column of `lines`.

    A line whose first sign is a digit and that has six fields must parse; `on_bad='drop'` leaves
    such lines out instead of failing.
    """
    keep = [c for c in lines.columns if c != "line"]
    parts = F.col("_parts")
    rows = (
        lines.filter(X.strip(F.col("line")).rlike("^[0-9]"))
        .select(*keep, "line", F.split("line", ",", 7).alias("_parts"))
        .filter(F.size(parts) >= 6)
    )
    names = ("_id", "station_name", "country", "_lat", "_lon", "_height")
    fields = computed_once(rows, [*keep, "line"], {n: X.field(parts, i) for i, n in enumerate(names)})
    # the three numbers of a coordinate, as arrays, before the rules look at them
    kept = [*keep, "line", *names]
    pieces = computed_once(fields, kept, {n: X.coordinate_parts(F.col(n[1:])) for n in ("__lat", "__lon")})
    height = F.col("_height")
    no_height = (height == "") | (height == S.MISSING_ELEVATION_TEXT)
    typed = computed_once(
        pieces,
        [*keep, "line", "station_name", "country"],
        {
            "station_id": X.to_unsigned(F.col("_id"), S.LARGEST_STATION),
            "latitude": X.degrees_from_parts(F.col("_lat"), F.col("__lat")),
            "longitude": X.degrees_from_parts(F.col("_lon"), F.col("__lon")),
            "elevation": F.when(~no_height, X.to_int(height)),
            "_no_height": no_height,
        },
    )
    bad = (
        F.col("station_id").isNull()
        | F.col("latitude").isNull()
        | F.col("longitude").isNull()
        | (F.col("elevation").isNull() & ~F.col("_no_height"))
    )
    if on_bad == "fail":
        fail = F.raise_error(F.concat(F.lit("bad station line: "), "line")).cast("boolean")
        typed = typed.filter(F.when(bad, fail).otherwise(F.lit(True)))
    elif on_bad == "drop":
        typed = typed.filter(~bad)
    else:
        raise ValueError(f"unknown choice for bad lines: {on_bad}")
    return typed.select(
        *keep, "station_id", "station_name", "country", "latitude", "longitude", "elevation"
    )


def last_station_wins(stations: DataFrame, *keys: str) -> DataFrame:
    """One row per station; of several lines of one file the last counts."""
    keys = list(keys) + ["station_id"]
    row = F.struct("station_name", "country", "latitude", "longitude", "elevation")
    return (
        stations.groupBy(*keys).agg(F.max_by(row, "line_pos").alias("s")).select(*keys, "s.*")
    )


def station_country_codes(lines: DataFrame) -> DataFrame:
    """The two-letter country codes of `stations.txt` lines, one row per line that has one."""
    parts = F.split("line", ",", 4)
    code = X.field(parts, 2)
    return lines.filter(
        ~X.is_banner(F.col("line"), "STAID") & (F.size(parts) >= 3) & (F.octet_length(code) == 2)
    ).select(*[c for c in lines.columns if c not in ("line", "line_pos")], code.alias("country"))


def parse_element_lines(lines: DataFrame) -> DataFrame:
    """Known elements listed in `elements.txt`."""
    ident = X.field(F.split("line", ",", 2), 0)
    prefix = F.regexp_extract(ident, r"^\p{IsAlphabetic}*", 0)
    return (
        lines.filter(~X.is_banner(F.col("line"), "ELEID") & prefix.isin(S.PREFIXES))
        .select(*[c for c in lines.columns if c not in ("line", "line_pos")], prefix.alias("element"))
        .distinct()
    )
