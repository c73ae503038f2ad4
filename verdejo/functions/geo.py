"""Great-circle distance, bounding boxes and the search grid."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


@dataclass(frozen=True)
class Box:
    lat_min: float
    lat_max: float
    lng_min: float
    lng_max: float

    def inside(self, lat: Column, lng: Column) -> Column:
        return lat.between(self.lat_min, self.lat_max) & lng.between(self.lng_min, self.lng_max)


# The country box of the point flag, and the tighter prototype box.
COUNTRY_BOX = Box(-34.0, 6.0, -75.0, -33.0)
PROTOTYPE_BOX = Box(-34.0, 5.5, -74.0, -34.0)


def outside(lat: Column, lng: Column, box: Box = COUNTRY_BOX) -> Column:
    """True outside the box; an unknown coordinate counts as outside."""
    return F.coalesce(~box.inside(lat, lng), F.lit(True))


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(chord))


class Grid:
    """Cells at least one search radius wide, so a neighbour lies at most one cell away.

    Latitude bands have equal height. Each band is cut into as many longitude
    cells as its distance from the equator allows.
    """

    def __init__(self, radius_km: float):
        self.arc = radius_km / EARTH_KM
        self.height = math.degrees(self.arc) * 1.000001

    def band(self, lat: Column) -> Column:
        return F.floor(lat / F.lit(self.height)).cast("int")

    def cells_in(self, band: Column) -> Column:
        # Widest span needed by any point one band away, measured from the pole side.
        edge = (F.greatest(F.abs(band), F.abs(band + 1)) + 1) * F.lit(self.height)
        reach = F.lit(math.sin(self.arc)) / F.cos(F.radians(edge))
        width = F.degrees(F.asin(F.least(reach, F.lit(1.0)))) * F.lit(1.000001)
        usable = (edge + F.lit(self.height) < 90) & (reach < 1)
        return F.when(usable, F.greatest(F.floor(F.lit(360.0) / width), F.lit(1))).otherwise(1).cast("int")

    def cell(self, band: Column, lng: Column) -> Column:
        cells = self.cells_in(band)
        return F.pmod(F.floor((lng + 180) / 360 * cells).cast("int"), cells)

    def around(self, lat: Column, lng: Column) -> Column:
        """Array of (band, cell) pairs that can hold a point within the radius."""
        own = self.band(lat)

        def row(step: int) -> Column:
            band = own + step
            cells = self.cells_in(band)
            mid = self.cell(band, lng)
            near = F.array_distinct(F.array(*[F.pmod(mid + d, cells) for d in (-1, 0, 1)]))
            return F.transform(near, lambda c: F.struct(band.alias("band"), c.alias("cell")))

        return F.concat(row(-1), row(0), row(1))
