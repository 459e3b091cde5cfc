"""Stations near each other."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions import geo as G


CELLS = 4  # grid cells to a radius
PART_ROWS = 1000  # stations that a part of a cell holds, about


def station_neighbours(stations: DataFrame, radius_km: float) -> DataFrame:
    """Pairs of stations (lower id first) at most `radius_km` apart, with the distance.

    Stations meet in grid cells about a quarter of the radius wide: each stands in its own cell and looks
    into the cells its radius touches, so pairs much farther apart never meet. Cells widen towards the
    poles and wrap at the date line. The stations of a full cell stand in parts of it, which all that look
    into it visit, so a task's share of the pairs doesn't depend on how the stations lie. Pairs that are
    farther apart by the product of their unit vectors go first; the rest are measured.
    """
    angle = radius_km / S.EARTH_RADIUS_KM
    if not 0 < angle < math.pi / 4:
        raise ValueError("radius must be positive and below 5000 km")
    span_lat = math.degrees(angle) * (1 + 1e-9)
    height = span_lat / CELLS
    lat, lon = F.col("latitude"), F.col("longitude")

    def band(x):
        return F.floor((x + 90.0) / height).cast("int")

    def cells_around(b):
        """Number of cells in a latitude band, from the widest place of the band."""
        edge = F.least(F.abs(b * height - 90.0), F.abs((b + 1) * height - 90.0))
        flat = F.when((b * height - 90.0) * ((b + 1) * height - 90.0) < 0, F.lit(0.0)).otherwise(edge)
        width = height / F.greatest(F.cos(F.radians(flat)), F.lit(1e-6))
        return F.greatest(F.lit(1), F.floor(F.lit(360.0) / width)).cast("int")

    def cell(x, n):
        return F.pmod(F.floor((x + 180.0) / (F.lit(360.0) / n)), n).cast("int")

    cores = stations.sparkSession.sparkContext.defaultParallelism
    # the pairs grow with the square of the stations, so the tasks grow with the stations
    tasks = max(int(stations.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * cores, -(-2 * stations.count() // PART_ROWS))
    y, x = F.radians(lat), F.radians(lon)
    vector = {"_x": F.cos(y) * F.cos(x), "_y": F.cos(y) * F.sin(x), "_z": F.sin(y)}
    base = stations.select("station_id", "latitude", "longitude").repartition(cores)
    homes = base.withColumns(vector).withColumn("_band", band(lat)).withColumn("_cell", cell(lon, cells_around(F.col("_band"))))
    parts = homes.groupBy("_band", "_cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(PART_ROWS)).cast("int").alias("_parts"))
    homes = homes.join(parts, ["_band", "_cell"]).withColumn("_part", F.pmod(F.xxhash64("station_id"), F.col("_parts")).cast("int"))

    # how far in longitude a point within the radius can lie; everything near a pole
    near_pole = F.abs(lat) + span_lat >= 90.0
    reach = F.degrees(F.asin(F.least(F.lit(1.0), math.sin(angle) / F.cos(F.radians(lat))))) * (1 + 1e-9)
    looks = base.withColumns(vector).withColumn("_band", F.explode(F.sequence(band(lat - span_lat), band(lat + span_lat))))
    n = cells_around(F.col("_band"))
    size = F.lit(360.0) / n
    low, high = F.floor((lon - reach + 180.0) / size), F.floor((lon + reach + 180.0) / size)
    all_cells = near_pole | (high - low + 1 >= n)
    span = F.when(all_cells, F.sequence(F.lit(0), n - 1)).otherwise(
        F.transform(F.sequence(low, high), lambda k: F.pmod(k, n).cast("int"))
    )
    looks = looks.select(
        F.col("station_id").alias("other_id"),
        lat.alias("other_lat"),
        lon.alias("other_lon"),
        *[F.col(c).alias(f"_o{c}") for c in vector],
        "_band",
        F.explode(span).alias("_cell"),
    )
    looks = looks.join(parts, ["_band", "_cell"]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    keys = ["_band", "_cell", "_part"]
    distance = G.haversine_km(lat, lon, F.col("other_lat"), F.col("other_lon"))
    product = sum((F.col(c) * F.col(f"_o{c}") for c in vector), F.lit(0.0))
    met = looks.drop("_parts").repartition(tasks, *keys).join(homes.drop("_parts").repartition(tasks, *keys).hint("shuffle_hash"), keys)
    return (
        met.filter((F.col("station_id") < F.col("other_id")) & (product >= math.cos(angle) - 1e-9))
        .withColumn("distance_km", distance)
        .filter(F.col("distance_km") <= radius_km)
        .select("station_id", "other_id", "distance_km")
    )
