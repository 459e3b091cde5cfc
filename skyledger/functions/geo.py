"""Station and place rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import schemas as S


def is_uk_country(country: Column) -> Column:
    return F.upper(country).isin(S.UK_COUNTRIES)


def in_box(latitude: Column, longitude: Column, box=S.UK_BOX) -> Column:
    return latitude.between(box[0], box[1]) & longitude.between(box[2], box[3])


def station_in_range(name: Column, latitude: Column, longitude: Column) -> Column:
    return (
        (F.length(name) >= 1)
        & latitude.between(*S.LATITUDE_RANGE)
        & longitude.between(*S.LONGITUDE_RANGE)
    )


def guess_countries(min_lon: Column, max_lat: Column) -> Column:
    """Countries suggested by the bounds of a dataset."""
    return (
        F.when((min_lon < -5.0) & (max_lat > 53.0), F.lit("GB/IE"))
        .when(max_lat > 55.0, F.lit("GB"))
        .otherwise(F.lit("IE"))
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon / 2), 2
    )
    # rounding may lift `a` a hair above 1 for opposite points
    return F.lit(2.0 * S.EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; NULL when there is nothing to share."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def years_by_days(first: Column, last: Column) -> Column:
    return F.floor(F.datediff(last, first) / F.lit(365)).cast("int")


def years_by_calendar(first: Column, last: Column) -> Column:
    return F.year(last) - F.year(first)
