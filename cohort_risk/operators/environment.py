"""Air-quality readings: newest per country, and within a radius of a point."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_risk.operators.dedup import top_per_group

EARTH_RADIUS_M = 6_371_000.0
SITE = ["site_lat", "site_lon"]
SPOT = ["spot_lat", "spot_lon"]


def latest_by_country(readings: DataFrame, id_col: str, limit: int | None) -> DataFrame:
    """The newest ``limit`` readings per country, all of them without a limit."""
    order = [F.desc_nulls_last("measured_at"), F.col(id_col)]
    return top_per_group(readings, ["country_iso3"], order, limit, rank="recency")


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    h = (F.pow(F.sin(half_lat), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


class _Grid:
    """Latitude bands as high as the radius, each cut into cells about as wide."""

    def __init__(self, radius_m: float):
        self.step = max(math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9), 1e-4)

    def band(self, lat: Column) -> Column:
        return F.floor((lat + 90) / self.step)

    def cells_in(self, band: Column) -> Column:
        low = band * self.step - 90
        widest = F.least(F.lit(90.0), F.greatest(F.abs(low), F.abs(low + self.step)))
        return F.greatest(F.lit(1).cast("bigint"),
                          F.floor(F.cos(F.radians(widest)) * 360 / self.step))

    def column(self, lon: Column, cells: Column) -> Column:
        return F.floor((lon + 180) / 360 * cells)

    def cell(self, lon: Column, cells: Column) -> Column:
        return F.pmod(self.column(lon, cells), cells)

    def reach(self, lat: Column) -> Column:
        """Largest difference in longitude within the radius, in degrees."""
        ratio = F.lit(math.sin(math.radians(self.step))) / F.cos(F.radians(lat))
        return (F.when(F.abs(lat) + self.step >= 90, 180.0)
                .otherwise(F.degrees(F.asin(F.least(F.lit(1.0), ratio))) + 1e-9))

    def covered(self, lat: Column, lon: Column, cells: Column) -> Column:
        """Cells of a band that the reach around a point touches."""
        first = self.column(lon - self.reach(lat), cells)
        last = self.column(lon + self.reach(lat), cells)
        everything = F.sequence(F.lit(0).cast("bigint"), cells - 1)
        span = F.transform(F.sequence(first, last), lambda i: F.pmod(i, cells))
        return F.when(last - first + 1 >= cells, everything).otherwise(span)


def within_radius(points: DataFrame, readings: DataFrame, id_col: str, k: int | None,
                  radius_m: float = 10_000) -> DataFrame:
    """The newest ``k`` readings within ``radius_m`` of every point, all of them without ``k``.

    ``points`` has latitude and longitude; ``readings`` has them too, ``measured_at``
    and the unique ``id_col``. Patients at one place and readings of one site are
    each combined first: only the newest k readings of a site can count, and only the
    k sites of a place whose newest readings are newest. Places meet sites by an
    equi-join on grid cells.
    """
    grid = _Grid(radius_m)
    recent = [F.desc_nulls_last("measured_at"), F.col(id_col)]
    located = (readings.withColumnsRenamed({"latitude": "site_lat", "longitude": "site_lon"})
               .dropna(subset=SITE))
    newest = top_per_group(located, SITE, recent, k, rank="__n")
    sites = (newest.filter(F.col("__n") == 1)
             .select(*SITE, "measured_at", id_col)
             .withColumn("band", grid.band(F.col("site_lat")))
             .withColumn("cell", grid.cell(F.col("site_lon"), grid.cells_in(F.col("band")))))
    spots = (points.select(F.col("latitude").alias("spot_lat"),
                           F.col("longitude").alias("spot_lon")).dropna().distinct())
    near = grid.band(F.col("spot_lat"))
    spots = (spots.withColumn("band", F.explode(F.array(near - 1, near, near + 1)))
             .withColumn("cell", F.explode(grid.covered(
                 F.col("spot_lat"), F.col("spot_lon"), grid.cells_in(F.col("band"))))))
    distance = haversine_m(F.col("spot_lat"), F.col("spot_lon"),
                           F.col("site_lat"), F.col("site_lon"))
    pairs = (spots.join(sites, ["band", "cell"])
             .withColumn("distance_m", distance)
             .filter(F.col("distance_m") <= radius_m))
    pairs = top_per_group(pairs, SPOT, recent, k).select(*SPOT, *SITE, "distance_m")
    found = top_per_group(pairs.join(newest.drop("__n"), SITE), SPOT, recent, k, rank="recency")
    found = found.withColumnsRenamed({"spot_lat": "latitude", "spot_lon": "longitude"})
    return points.join(found, ["latitude", "longitude"])
