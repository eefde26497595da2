"""Inverse transverse Mercator and datum shift over arrays of coordinates.

Formulas: J. P. Snyder, Map Projections - A Working Manual (USGS Professional Paper 1395), section 8.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import radians, sin, sqrt

import numpy as np

US_FOOT = 1200 / 3937  # metres


@dataclass(frozen=True)
class Ellipsoid:
    a: float
    b: float

    @property
    def e2(self) -> float:
        return 1 - (self.b / self.a) ** 2

    @property
    def ep2(self) -> float:
        return (self.a / self.b) ** 2 - 1

    def meridian(self, lat: float) -> float:
        """Meridian arc from the equator, metres."""
        e2, e4, e6 = self.e2, self.e2**2, self.e2**3
        return self.a * (
            (1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * lat
            - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * sin(2 * lat)
            + (15 * e4 / 256 + 45 * e6 / 1024) * sin(4 * lat)
            - (35 * e6 / 3072) * sin(6 * lat)
        )


@dataclass(frozen=True)
class TransverseMercator:
    ellipsoid: Ellipsoid
    lat0: float
    lon0: float
    k0: float
    false_easting: float  # metres
    unit: float  # metres per coordinate unit


# Published ellipsoids and zone parameters.
CLARKE_1866 = Ellipsoid(6378206.4, 6356583.8)
GRS_80 = Ellipsoid(6378137.0, 6356752.314140356)
WGS_84 = Ellipsoid(6378137.0, 6356752.314245179)

CRS = {
    26796: TransverseMercator(CLARKE_1866, 35 + 50 / 60, -90.5, 1 - 1 / 15000, 500000 * US_FOOT, US_FOOT),
    102696: TransverseMercator(GRS_80, 35 + 50 / 60, -90.5, 1 - 1 / 15000, 250000.0, US_FOOT),
}

# Mean geocentric shift from the 1927 datum, conterminous United States, metres.
CONUS_1927_SHIFT = (-8.0, 160.0, 176.0)


def inverse(crs: TransverseMercator, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Projected coordinates to longitude and latitude in degrees, on the projection's own datum."""
    ell = crs.ellipsoid
    e2, ep2 = ell.e2, ell.ep2
    e1 = (1 - sqrt(1 - e2)) / (1 + sqrt(1 - e2))
    per_arc = ell.a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256)
    mu = (ell.meridian(radians(crs.lat0)) + y * crs.unit / crs.k0) / per_arc
    foot = (
        mu
        + (3 * e1 / 2 - 27 * e1**3 / 32) * np.sin(2 * mu)
        + (21 * e1**2 / 16 - 55 * e1**4 / 32) * np.sin(4 * mu)
        + (151 * e1**3 / 96) * np.sin(6 * mu)
        + (1097 * e1**4 / 512) * np.sin(8 * mu)
    )
    cos, tan = np.cos(foot), np.tan(foot)
    w2 = 1 - e2 * np.sin(foot) ** 2
    normal = ell.a / np.sqrt(w2)
    c, t = ep2 * cos**2, tan**2
    d = (x * crs.unit - crs.false_easting) / (normal * crs.k0)
    lat = foot - tan * w2 / (1 - e2) * (
        d**2 / 2
        - (5 + 3 * t + 10 * c - 4 * c**2 - 9 * ep2) * d**4 / 24
        + (61 + 90 * t + 298 * c + 45 * t**2 - 252 * ep2 - 3 * c**2) * d**6 / 720
    )
    lon = (
        d
        - (1 + 2 * t + c) * d**3 / 6
        + (5 - 2 * c + 28 * t - 3 * c**2 + 8 * ep2 + 24 * t**2) * d**5 / 120
    ) / cos
    return crs.lon0 + np.degrees(lon), np.degrees(lat)


def shift_datum(source: Ellipsoid, shift: tuple[float, float, float], lon: np.ndarray, lat: np.ndarray):
    """Geodetic to geocentric at height zero, translate, and back on WGS 84 (Bowring's formula)."""
    phi, lam = np.radians(lat), np.radians(lon)
    n = source.a / np.sqrt(1 - source.e2 * np.sin(phi) ** 2)
    x = n * np.cos(phi) * np.cos(lam) + shift[0]
    y = n * np.cos(phi) * np.sin(lam) + shift[1]
    z = n * (1 - source.e2) * np.sin(phi) + shift[2]
    r = np.hypot(x, y)
    u = np.arctan2(z * WGS_84.a, r * WGS_84.b)
    up = z + WGS_84.ep2 * WGS_84.b * np.sin(u) ** 3
    out = r - WGS_84.e2 * WGS_84.a * np.cos(u) ** 3
    return np.degrees(np.arctan2(y, x)), np.degrees(np.arctan2(up, out))


def to_degrees(srid: int, shift: tuple[float, float, float] | None, x: np.ndarray, y: np.ndarray):
    """Coordinates of ``srid`` to longitude and latitude, with an optional datum shift."""
    crs = CRS[srid]
    lon, lat = inverse(crs, x, y)
    return shift_datum(crs.ellipsoid, shift, lon, lat) if shift else (lon, lat)
