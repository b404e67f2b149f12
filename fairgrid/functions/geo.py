"""Geographic columns: the transverse Mercator grid, distances, coordinate checks (GEO-01, GEO-02, FLT-03)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ellipsoid GRS 80 and the unified Korean transverse Mercator projection (EPSG:5179).
AXIS, FLATTENING = 6378137.0, 1 / 298.257222101
LAT0, LON0, SCALE, EAST0, NORTH0 = 38.0, 127.5, 0.9996, 1_000_000.0, 2_000_000.0
EARTH_KM = 6371.0088
_N = FLATTENING / (2 - FLATTENING)
_RADIUS = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_E = math.sqrt(FLATTENING * (2 - FLATTENING))
#: Krueger's series to the fourth power of the third flattening, forward and back (Karney 2011).
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45, 56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630)


def _meridian(lat: float) -> float:
    """Rectified distance from the equator of the origin's latitude."""
    s = math.sin(lat)
    t = math.sinh(math.atanh(s) - _E * math.atanh(_E * s))
    xi = math.atan(t)
    return xi + sum(a * math.sin(2 * (j + 1) * xi) for j, a in enumerate(_ALPHA))


_XI0 = _meridian(math.radians(LAT0))


def to_metres(lon: Column, lat: Column) -> tuple[Column, Column]:
    """GEO-01: (east, north) in metres of degrees, by native functions only."""
    s, dl = F.sin(F.radians(lat)), F.radians(lon - F.lit(LON0))
    t = F.sinh(F.atanh(s) - _E * F.atanh(_E * s))
    xi, eta = F.atan2(t, F.cos(dl)), F.asinh(F.sin(dl) / F.sqrt(t * t + F.cos(dl) * F.cos(dl)))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return EAST0 + SCALE * _RADIUS * x, NORTH0 + SCALE * _RADIUS * (y - _XI0)


def to_degrees(east: Column, north: Column) -> tuple[Column, Column]:
    """GEO-01: (lon, lat) of metres."""
    xi, eta = (north - NORTH0) / (SCALE * _RADIUS) + _XI0, (east - EAST0) / (SCALE * _RADIUS)
    a, b = xi, eta
    for j, k in enumerate(_BETA, 1):
        a = a - k * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        b = b - k * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(a) / F.cosh(b))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.lit(LON0) + F.degrees(F.atan2(F.sinh(b), F.cos(a))), F.degrees(lat)


def cell(metres: Column, size: int = 500) -> Column:
    """The lower corner of a coordinate's cell."""
    return (F.floor(metres / size) * size).cast("int")


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """GEO-02: great-circle distance."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)))


def valid_coordinates(lon: Column, lat: Column) -> Column:
    """FLT-03: inside the box 120 to 135 east, 30 to 45 north; false if missing."""
    return F.coalesce(lon.between(120, 135) & lat.between(30, 45), F.lit(False))
