"""Quality rules on wide records (`weather` layout) and on the older nine-column layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .. import schemas as S
from ..schemas import f32


def _inside(value: Column, limits: tuple[float, float]) -> Column:
    return value.between(f32(limits[0]), f32(limits[1]))


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


# --- presence ----------------------------------------------------------------------------------


def has_temperature() -> Column:
    return F.coalesce("temp_min", "temp_max", "temp_avg").isNotNull()


def has_complete_temperature() -> Column:
    return F.col("temp_min").isNotNull() & F.col("temp_max").isNotNull() & F.col("temp_avg").isNotNull()


def has_precipitation() -> Column:
    return F.col("precipitation").isNotNull()


def has_wind() -> Column:
    return F.col("wind_speed").isNotNull()


def available_metrics() -> Column:
    return F.array_compact(
        F.array(
            F.when(has_temperature(), "temperature"),
            F.when(has_precipitation(), "precipitation"),
            F.when(has_wind(), "wind_speed"),
        )
    )


def metric_coverage() -> Column:
    present = has_temperature().cast("int") + has_precipitation().cast("int") + has_wind().cast("int")
    return (present.cast("float") / F.lit(3)).cast("float")


def temperature_range() -> Column:
    return F.col("temp_max") - F.col("temp_min")


# --- source flags ------------------------------------------------------------------------------


def temperature_flag_valid() -> Column:
    return _sure(F.col("temp_quality") == "000")


def precipitation_flag_valid() -> Column:
    return _sure(F.col("precip_quality") == "0")


def wind_flag_valid() -> Column:
    return _sure(F.col("wind_quality") == "0")


def _any_flag(digit: str) -> Column:
    names = ["temp_quality", "precip_quality", "wind_quality"]
    return reduce(lambda a, b: a | b, [_sure(F.col(c).contains(digit)) for c in names])


def has_suspect_flag() -> Column:
    return _any_flag("1")


def has_missing_flag() -> Column:
    return _any_flag("9")


def flag_is_legal(flag: Column) -> Column:
    return flag.isin(S.FLAGS)


def flag_is_usable(flag: Column) -> Column:
    return flag.isin([0, 1])


def flag_is_strict(flag: Column) -> Column:
    return flag == 0


# --- physical limits ---------------------------------------------------------------------------


def _temperature_grade(value: Column) -> Column:
    return F.when(value.isNotNull() & ~_inside(value, S.TEMP_POSSIBLE), "Invalid").when(
        value.isNotNull() & ~_inside(value, S.TEMP_EXPECTED), "Suspect"
    )


def temperature_validity() -> Column:
    """Minimum, maximum and mean are looked at in this order; the first bad one decides."""
    return F.coalesce(
        _temperature_grade(F.col("temp_min")),
        _temperature_grade(F.col("temp_max")),
        _temperature_grade(F.col("temp_avg")),
        F.when(has_temperature(), "Valid"),
    )


def _amount_validity(value: Column, possible: tuple[float, float], expected_max: float) -> Column:
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(~_inside(value, possible), "Invalid")
        .when(value > f32(expected_max), "Suspect")
        .otherwise("Valid")
    )


def precipitation_validity() -> Column:
    return _amount_validity(F.col("precipitation"), S.PRECIP_POSSIBLE, S.PRECIP_EXPECTED_MAX)


def wind_validity() -> Column:
    return _amount_validity(F.col("wind_speed"), S.WIND_POSSIBLE, S.WIND_EXPECTED_MAX)


def with_physical_validity(df):
    return df.withColumns(
        {
            "temp_validation": temperature_validity(),
            "precip_validation": precipitation_validity(),
            "wind_validation": wind_validity(),
        }
    )


# --- flags and limits combined -----------------------------------------------------------------


def _combined(missing: Column, suspect: Column, validity: Column) -> Column:
    missing, suspect = _sure(missing), _sure(suspect)
    out_of_climate = _sure(validity == "Suspect")
    return (
        F.when(missing, "Missing")
        .when(_sure(validity == "Invalid"), "Invalid")
        .when(suspect & out_of_climate, "SuspectBoth")
        .when(suspect, "SuspectOriginal")
        .when(out_of_climate, "SuspectRange")
        .otherwise("Valid")
    )


def temperature_quality() -> Column:
    q = F.col("temp_quality")
    return _combined(q.contains("9"), q.contains("1"), F.col("temp_validation"))


def precipitation_quality() -> Column:
    q = F.col("precip_quality")
    return _combined(q == "9", q == "1", F.col("precip_validation"))


def wind_quality() -> Column:
    q = F.col("wind_quality")
    return _combined(q == "9", q == "1", F.col("wind_validation"))


def has_invalid_data() -> Column:
    return (
        (temperature_quality() == "Invalid")
        | (precipitation_quality() == "Invalid")
        | (wind_quality() == "Invalid")
    )


def has_high_quality_data() -> Column:
    return (
        (F.col("temp_validation").isNull() | (temperature_quality() == "Valid"))
        & (F.col("precip_validation").isNull() | (precipitation_quality() == "Valid"))
        & (F.col("wind_validation").isNull() | (wind_quality() == "Valid"))
    )


# --- consistency of a record -------------------------------------------------------------------


def order_break(low: Column, mid: Column, high: Column, tolerance: float) -> Column:
    """Needs all three values; the lower break is named first."""
    slack = f32(tolerance)
    complete = low.isNotNull() & mid.isNotNull() & high.isNotNull()
    return F.when(complete & (low > mid + slack), "MinGreaterThanAvg").when(
        complete & (mid > high + slack), "AvgGreaterThanMax"
    )


def _range_break(columns: dict[str, tuple[float, float]]) -> Column:
    bad = []
    for name, (low, high) in columns.items():
        kind = "double" if name in ("latitude", "longitude") else "float"
        value = F.col(name)
        bad.append(value.isNotNull() & ~value.between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    return F.when(reduce(lambda a, b: a | b, bad), "OutOfRange")


def record_violation() -> Column:
    """Name of the first broken rule of a record, or NULL."""
    return F.coalesce(
        order_violation(),
        _range_break(
            {
                "latitude": S.LATITUDE_RANGE,
                "longitude": S.LONGITUDE_RANGE,
                "temp_min": S.TEMP_RANGE,
                "temp_max": S.TEMP_RANGE,
                "temp_avg": S.TEMP_RANGE,
                "precipitation": S.PRECIP_RANGE,
                "wind_speed": S.WIND_RANGE,
            }
        ),
    )


def order_violation() -> Column:
    """The min / mean / max order only; needs all three values."""
    return order_break(F.col("temp_min"), F.col("temp_avg"), F.col("temp_max"), S.ORDER_TOLERANCE)


def triple_violation(low: Column, mid: Column, high: Column) -> Column:
    """The narrow check on raw triples (tolerance 0.1)."""
    return order_break(low, mid, high, S.TRIPLE_TOLERANCE)


def positional_flags(low: Column, mid: Column, high: Column) -> Column:
    """Three flag digits, minimum, mean, maximum; an absent part is 9."""
    return F.concat(*[F.coalesce(q.cast("string"), F.lit("9")) for q in (low, mid, high)])


# --- nine-column layout ------------------------------------------------------------------------


def temperature_in_range(value: Column) -> Column:
    return (value != f32(S.MISSING_V1)) & _inside(value, S.TEMP_RANGE)


def v1_violation() -> Column:
    return F.coalesce(
        order_break(F.col("min_temp"), F.col("avg_temp"), F.col("max_temp"), S.ORDER_TOLERANCE),
        _range_break(
            {
                "latitude": S.LATITUDE_RANGE,
                "longitude": S.LONGITUDE_RANGE,
                "min_temp": S.TEMP_RANGE,
                "max_temp": S.TEMP_RANGE,
                "avg_temp": S.TEMP_RANGE,
            }
        ),
    )


def v1_valid() -> Column:
    return F.col("quality_flags") == "000"


def v1_suspect() -> Column:
    return F.col("quality_flags").contains("1")


def v1_missing() -> Column:
    return F.col("quality_flags").contains("9")


def v1_temperature_range() -> Column:
    return F.col("max_temp") - F.col("min_temp")
