"""Record layouts and the fixed values every plan agrees on."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# --- fixed values: element prefixes, names and units -------------------------------------------
# (prefix, wide column, display name, unit, metric group)
ELEMENTS = [
    ("TN", "temp_min", "Temperature (Min)", "0.1°C", "temperature"),
    ("TX", "temp_max", "Temperature (Max)", "0.1°C", "temperature"),
    ("TG", "temp_avg", "Temperature (Avg)", "0.1°C", "temperature"),
    ("RR", "precipitation", "Precipitation", "0.1mm", "precipitation"),
    ("FG", "wind_speed", "Wind Speed", "0.1 m/s", "wind_speed"),
]
PREFIXES = [e[0] for e in ELEMENTS]
TEMPERATURE_PREFIXES = ["TN", "TX", "TG"]
METRICS = ["temperature", "precipitation", "wind_speed"]

# --- fixed values: file layout -----------------------------------------------------------------
HEADER_LINES = 20
MISSING_TEXT = "-9999"
MISSING_ELEVATION_TEXT = "-999"
MISSING_V1 = -9999.0
LARGEST_STATION = 4294967295
STATIONS_FILE = "stations.txt"
ELEMENTS_FILE = "elements.txt"
METADATA_ENTRIES = ["stations.txt", "elements.txt", "metadata.txt", "sources.txt"]
BANNER_MARKS = ["EUROPEAN", "Klein Tank"]
V1_FOLDERS = {"uk_temp_min": "TN", "uk_temp_max": "TX", "uk_temp_avg": "TG"}

# --- fixed values: quality flags and limits ----------------------------------------------------
FLAGS = [0, 1, 9]  # valid, suspect, missing
TEMP_POSSIBLE = (-90.0, 60.0)
TEMP_EXPECTED = (-35.0, 45.0)
PRECIP_POSSIBLE = (0.0, 2000.0)
PRECIP_EXPECTED_MAX = 500.0
WIND_POSSIBLE = (0.0, 120.0)
WIND_EXPECTED_MAX = 50.0
TEMP_RANGE = (-50.0, 50.0)
PRECIP_RANGE = (0.0, 1000.0)
WIND_RANGE = (0.0, 100.0)
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)
ORDER_TOLERANCE = 1.0
TRIPLE_TOLERANCE = 0.1
JUMP_LIMIT = 20.0
UK_BOX = (49.5, 61.0, -8.0, 2.0)  # lat min, lat max, lon min, lon max
UK_COUNTRIES = ["GB", "UK", "UNITED KINGDOM"]
EARTH_RADIUS_KM = 6371.0
ROW_GROUP_ROWS = 10_000
CODECS = ["snappy", "gzip", "lz4", "zstd", "none"]

# Bits of the packed processing order that belong to one archive: an archive may hold 2**44 bytes
# of text (16 TiB) and a dataset 2**19 archives. The readers raise when either is exceeded.
SEQ_BITS = 44

WEATHER = T.StructType(
    [
        T.StructField("station_id", T.LongType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("temp_min", T.FloatType()),
        T.StructField("temp_max", T.FloatType()),
        T.StructField("temp_avg", T.FloatType()),
        T.StructField("precipitation", T.FloatType()),
        T.StructField("wind_speed", T.FloatType()),
        T.StructField("temp_quality", T.StringType()),
        T.StructField("precip_quality", T.StringType()),
        T.StructField("wind_quality", T.StringType()),
        T.StructField("temp_validation", T.StringType()),
        T.StructField("precip_validation", T.StringType()),
        T.StructField("wind_validation", T.StringType()),
    ]
)
WEATHER_COLUMNS = WEATHER.fieldNames()
WEATHER_VALUES = [e[1] for e in ELEMENTS]
VALIDATION_COLUMNS = ["temp_validation", "precip_validation", "wind_validation"]

CONSOLIDATED = T.StructType(
    [
        T.StructField("station_id", T.LongType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("min_temp", T.FloatType()),
        T.StructField("max_temp", T.FloatType()),
        T.StructField("avg_temp", T.FloatType()),
        T.StructField("quality_flags", T.StringType()),
    ]
)
CONSOLIDATED_COLUMNS = CONSOLIDATED.fieldNames()

# Long form: one row per station, day and element as read. `seq` is the processing order inside
# the archive (element by element, file by file, line by line); the last row of a key wins.
OBSERVATIONS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("archive_ord", T.IntegerType()),
        T.StructField("entry", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("station_id", T.LongType()),
        T.StructField("source_id", T.LongType()),
        T.StructField("obs_date", T.DateType()),
        T.StructField("element", T.StringType()),
        T.StructField("value", T.FloatType()),
        T.StructField("qflag", T.IntegerType()),
    ]
)


def f32(x: float) -> Column:
    """A FLOAT literal, so that comparisons and sums stay in single precision."""
    return F.lit(x).cast("float")
