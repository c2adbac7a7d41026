"""Sphere and regular-grid expressions (metres, degrees)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius (m), metres per degree used for cell lengths, km per degree on the plane.
EARTH_RADIUS = 6371008.8
METRES_PER_DEGREE = 112e3
KM_PER_DEGREE = 111.1


def great_circle(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    """Haversine distance in metres."""
    dlat = F.radians(lat_b - lat_a) / 2.0
    dlon = F.radians(lon_b - lon_a) / 2.0
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2.0 * EARTH_RADIUS) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def cell_area(lon0: Column, lon1: Column, lat0: Column, lat1: Column) -> Column:
    """SF-33: area of a longitude-latitude box on the sphere."""
    return (
        (F.sin(F.radians(lat1)) - F.sin(F.radians(lat0)))
        * (F.radians(lon1) - F.radians(lon0))
        * F.lit(EARTH_RADIUS * EARTH_RADIUS)
    )


def effective_radius(area: Column, method: str = "disc") -> Column:
    """SF-35: radius that stands for a cell.

    `disc` has the cell's area, `half_side` is half the side of the square with
    that area, `half_diagonal` half its diagonal, `polar_25km` a constant.
    """
    if method == "disc":
        return F.sqrt(area / F.lit(math.pi))
    if method == "half_side":
        return F.lit(0.5) * F.sqrt(area)
    if method == "half_diagonal":
        return F.lit(0.5) * F.sqrt(area) * F.lit(math.sqrt(2.0))
    if method == "polar_25km":
        return F.lit(25e3 * math.sqrt(2.0))
    raise ValueError(f"unknown radius method {method!r}")


def source_lengths(resolution: Column, max_lat: Column) -> Column:
    """SF-36: struct(shortest, longest) distance between neighbours of a regular source grid."""
    longest = resolution * F.lit(METRES_PER_DEGREE)
    return F.struct((F.cos(F.radians(max_lat)) * longest).alias("shortest"), longest.alias("longest"))


def neighbour_cap(max_radius: Column, shortest: Column, neighbours: int) -> Column:
    """SF-37: no more source cells fit inside the largest target than this."""
    fits = F.ceil(F.pow(max_radius * 2.0 / shortest, F.lit(2.0)))
    return F.least(fits.cast("long"), F.lit(neighbours).cast("long"))


def wrap_longitude(lon: Column) -> Column:
    """SF-38: to [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def planar_km(lon: Column, lat: Column, lon0: Column, lat0: Column) -> Column:
    """SF-39: distance on the plane scaled at the reference latitude."""
    dx = F.lit(KM_PER_DEGREE) * F.cos(F.radians(lat0)) * wrap_longitude(lon - lon0)
    dy = F.lit(KM_PER_DEGREE) * (lat - lat0)
    return F.sqrt(dx * dx + dy * dy)


def in_box(lon: Column, lat: Column, south: float, north: float, west: float, east: float) -> Column:
    """PRJ-6: box that may cross the date line; a hair of slack keeps the western edge out."""
    width = (east - west - 1e-5) % 360.0
    return lat.between(F.lit(float(south)), F.lit(float(north))) & (
        F.pmod(lon - F.lit(float(west)) - F.lit(1e-5), F.lit(360.0)) <= F.lit(width)
    )


def bytes_of(size_mb: Column) -> Column:
    """SF-41."""
    return size_mb * F.lit(float(2**20))


def gigabytes(size_bytes: Column) -> Column:
    """SF-41: gigabytes to three decimals."""
    return F.round(size_bytes / F.lit(float(2**30)), 3)
