"""Field rules of the text inputs: names, numbers, dates and coordinates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import ELEMENTS, LARGEST_STATION

# Characters stripped around a field (Unicode white space).
BLANKS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_INTEGER = r"\A[+-]?[0-9]+\z"
_UNSIGNED = r"\A\+?[0-9]+\z"
_DECIMAL = r"(?i)\A[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\z"


def strip(text: Column) -> Column:
    """`text` without the white space around it."""
    return F.trim(text, F.lit(BLANKS))


def is_plain(text: Column) -> Column:
    """Whether `text` is printable ASCII, so that blanks are its only white space."""
    return text.rlike(r"\A[ -~]*\z")


def field(parts: Column, i: int, plain: Column | None = None) -> Column:
    """The i-th comma-separated field without its surrounding blanks; NULL when absent.

    Where `plain` holds for the line, the much faster trim of blanks is enough.
    """
    text = F.get(parts, F.lit(i))
    return strip(text) if plain is None else F.when(plain, F.trim(text)).otherwise(strip(text))


def to_int(text: Column) -> Column:
    return F.when(text.rlike(_INTEGER), text.try_cast("int"))


def to_unsigned(text: Column, top: int) -> Column:
    number = F.when(text.rlike(_UNSIGNED), text.try_cast("bigint"))
    return F.when(number <= top, number)


def to_decimal(text: Column, kind: str) -> Column:
    """Decimal text as `kind` (float or double); type suffixes and hexadecimal are refused."""
    return F.when(text.rlike(_DECIMAL), text.try_cast(kind))


def to_date(text: Column) -> Column:
    """`yyyyMMdd`; the day may have one digit and blanks may stand between the parts."""
    # a cast of the dashed form is several times faster than parsing by pattern
    dashed = F.concat_ws("-", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2))
    plain = F.when(text.rlike(r"\A[0-9]{8}\z"), dashed.try_cast("date"))
    loose = r"\A([0-9]{1,4}+)\s*+([0-9]{1,2}+)\s*+([0-9]{1,2})\z"
    padded = F.concat(
        F.lpad(F.regexp_extract(text, loose, 1), 4, "0"),
        F.lpad(F.regexp_extract(text, loose, 2), 2, "0"),
        F.lpad(F.regexp_extract(text, loose, 3), 2, "0"),
    )
    return F.coalesce(
        plain, F.when(text.rlike(loose), F.try_to_date(padded, "yyyyMMdd"))
    )


def scale_tenths(tenths: Column) -> Column:
    """Tenths of a unit to the unit, in single precision."""
    return (tenths.cast("float") / F.lit(10)).cast("float")


# --- file and entry names ----------------------------------------------------------------------


def entry_prefix(entry: Column) -> Column:
    """Text before the first `_STAID` of a `.txt` name, when it is a known element; else NULL."""
    stem = F.regexp_extract(entry, r"(?s)\A(.*)\.txt\z", 1)
    prefix = F.regexp_extract(stem, r"(?s)^(.*?)_STAID", 1)
    return F.when(prefix.isin([e[0] for e in ELEMENTS]), prefix)


def entry_station(entry: Column) -> Column:
    """Digits between the first `STAID` and the next dot; leading zeros cut, all-zero is NULL."""
    text = F.regexp_extract(entry, r"(?s)^.*?STAID([^.]*)\.", 1)
    significant = F.regexp_replace(text, "^0+", "")
    return to_unsigned(significant, LARGEST_STATION)


def _element_case(key: Column, source: int, target: int) -> Column:
    chain = None
    for e in ELEMENTS:
        hit, value = key == e[source], F.lit(e[target])
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain


def element_display_name(prefix: Column) -> Column:
    return _element_case(prefix, 0, 2)


def element_units(prefix: Column) -> Column:
    return _element_case(prefix, 0, 3)


def element_metric(prefix: Column) -> Column:
    return _element_case(prefix, 0, 4)


def element_prefix(display_name: Column) -> Column:
    return _element_case(display_name, 2, 0)


def is_banner(text: Column, column_title: str) -> Column:
    """Heading lines of the metadata files: blank, title, rule or licence banner."""
    line = strip(text)
    return (
        (line == "")
        | line.startswith(column_title)
        | line.startswith("---")
        | line.contains("EUROPEAN")
        | line.contains("Klein Tank")
    )


# --- coordinates -------------------------------------------------------------------------------


def coordinate_parts(text: Column) -> Column:
    """The numbers of a coordinate, one for decimal text, three for `D:M:S`; NULL where not a number."""
    return F.transform(F.split(strip(text), ":"), lambda t: to_decimal(t, "double"))


def degrees_from_parts(text: Column, parts: Column) -> Column:
    """Decimal degrees from `coordinate_parts`; NULL when the text is not well formed.

    Minutes and seconds lie in [0, 60); a minus sign in front turns the whole value.
    """
    deg, minutes, seconds = (F.get(parts, F.lit(i)) for i in range(3))
    size = F.abs(deg) + minutes / F.lit(60.0) + seconds / F.lit(3600.0)
    ok = (minutes >= 0) & (minutes < 60) & (seconds >= 0) & (seconds < 60)
    dms = F.when(ok, F.when(strip(text).startswith("-"), -size).otherwise(size))
    return F.when(F.size(parts) == 1, deg).when(F.size(parts) == 3, dms)


def to_degrees(text: Column) -> Column:
    """A coordinate in `D:M:S` or in decimal form."""
    return degrees_from_parts(text, coordinate_parts(text))


def degrees_to_dms(degrees: Column) -> Column:
    """Decimal degrees as `D:MM:SS.ss`."""
    size = F.abs(degrees)
    whole = F.floor(size)
    minutes_part = (size - whole) * F.lit(60.0)
    minutes = F.floor(minutes_part)
    seconds = (minutes_part - minutes) * F.lit(60.0)
    return F.concat(
        F.when(degrees < 0, "-").otherwise(""),
        F.format_string("%d:%02d:%05.2f", whole, minutes, seconds),
    )
