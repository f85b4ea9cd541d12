"""Map projections as column expressions, by Snyder (1987): Albers equal area (EPSG 5070) and UTM on WGS 84."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Semi-major axis and flattening of GRS 80 and WGS 84 (fixed values).
A, FLATTENING_GRS80, FLATTENING_WGS84 = 6378137.0, 1 / 298.257222101, 1 / 298.257223563
#: Standard parallels and origin of EPSG 5070, degrees (fixed values).
PARALLELS, ORIGIN = (29.5, 45.5), (23.0, -96.0)
SCALE, FALSE_EASTING = 0.9996, 500000.0
#: What counts as rounding past a pole: degrees of latitude, and sines of the authalic latitude (under 2 cm of EPSG 5070).
PAST_DEGREES, PAST_SINE = 1e-10, 1e-9

Point = tuple[Column, Column]


def _albers() -> tuple[float, float, float, float, Callable[[float], float]]:
    e2 = FLATTENING_GRS80 * (2 - FLATTENING_GRS80)
    e = math.sqrt(e2)

    def q(phi: float) -> float:
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    m = lambda phi: math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    p1, p2 = map(math.radians, PARALLELS)
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    return e2, n, c, A * math.sqrt(c - n * q(math.radians(ORIGIN[0]))) / n, q


def albers(lon: Column, lat: Column) -> Point:
    """Degrees to metres of EPSG 5070; NULL past a pole, where a sine is that of another point."""
    e2, n, c, rho0, _ = _albers()
    e = math.sqrt(e2)
    s = F.sin(F.radians(F.when(F.abs(lat) <= 90 + PAST_DEGREES, lat)))
    q = (1 - e2) * (s / (1 - e2 * s * s) - F.ln((1 - e * s) / (1 + e * s)) / (2 * e))
    rho, theta = A * F.sqrt(c - n * q) / n, n * F.radians(lon - ORIGIN[1])
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def from_albers(x: Column, y: Column) -> Point:
    """Metres of EPSG 5070 to degrees; NULL inside the arc that is a pole, and outside the other's."""
    e2, n, c, rho0, _ = _albers()
    e = math.sqrt(e2)
    rho, theta = F.sqrt(x * x + (rho0 - y) * (rho0 - y)), F.atan2(x, rho0 - y)
    q = (c - rho * rho * n * n / (A * A)) / n
    sine = q / (1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e)))
    beta = F.asin(F.when(F.abs(sine) <= 1 + PAST_SINE, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sine))))
    e4, e6 = e2 * e2, e2**3
    phi = beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
    return F.when(phi.isNotNull(), ORIGIN[1] + F.degrees(theta / n)), F.degrees(phi)


def utm(lon: Column, lat: Column, zone: int = 10) -> Point:
    """Degrees to metres of a northern UTM zone."""
    e2 = FLATTENING_WGS84 * (2 - FLATTENING_WGS84)
    ep2 = e2 / (1 - e2)
    phi, a = F.radians(lat), None
    s, k = F.sin(phi), F.cos(phi)
    n, t, c = A / F.sqrt(1 - e2 * s * s), F.tan(phi) * F.tan(phi), ep2 * k * k
    a = F.radians(lon - (6 * zone - 183)) * k
    e4, e6 = e2 * e2, e2**3
    m = A * ((1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi) + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi) - 35 * e6 / 3072 * F.sin(6 * phi))
    x = SCALE * n * (a + (1 - t + c) * F.pow(a, F.lit(3)) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(a, F.lit(5)) / 120) + FALSE_EASTING
    y = SCALE * (m + n * F.tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, F.lit(4)) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(a, F.lit(6)) / 720))
    return x, y


def from_utm(x: Column, y: Column, zone: int = 10) -> Point:
    """Metres of a northern UTM zone to degrees."""
    e2 = FLATTENING_WGS84 * (2 - FLATTENING_WGS84)
    ep2, e1 = e2 / (1 - e2), (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = y / SCALE / (A * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    phi = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + 151 * e1**3 / 96 * F.sin(6 * mu) + 1097 * e1**4 / 512 * F.sin(8 * mu)
    s, k = F.sin(phi), F.cos(phi)
    n, t, c = A / F.sqrt(1 - e2 * s * s), F.tan(phi) * F.tan(phi), ep2 * k * k
    r = A * (1 - e2) / F.pow(1 - e2 * s * s, F.lit(1.5))
    d = (x - FALSE_EASTING) / (n * SCALE)
    lat = phi - n * F.tan(phi) / r * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * F.pow(d, F.lit(4)) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * F.pow(d, F.lit(6)) / 720)
    lon = (d - (1 + 2 * t + c) * F.pow(d, F.lit(3)) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * F.pow(d, F.lit(5)) / 120) / k
    return 6 * zone - 183 + F.degrees(lon), F.degrees(lat)


def half_turns(lat: Column) -> Column:
    """How many poles a latitude that is counted on along its meridian has passed; 0 from -90 to 90."""
    return F.rint(lat / 180.0)


def _opposite(lon: Column, turns: Column) -> Column:
    return F.when(turns % 2 != 0, F.when(lon > 0, lon - 180.0).otherwise(lon + 180.0)).otherwise(lon)


def on_globe(lon: Column, lat: Column, turns: Column) -> Point:
    """The longitude and latitude of a point whose latitude is counted on past poles: 97 degrees are 83 of the opposite meridian."""
    left = lat - 180.0 * turns
    return _opposite(lon, turns), F.when(turns % 2 != 0, -left).otherwise(left)


def counted_on(lon: Column, lat: Column, turns: Column) -> Point:
    """The reverse of on_globe, given the poles that were passed."""
    return _opposite(lon, turns), 180.0 * turns + F.when(turns % 2 != 0, -lat).otherwise(lat)


#: To and from degrees, by EPSG code.
TO_DEGREES: dict[int, Callable[[Column, Column], Point]] = {4326: lambda x, y: (x, y), 5070: from_albers, 32610: from_utm}
FROM_DEGREES: dict[int, Callable[[Column, Column], Point]] = {4326: lambda x, y: (x, y), 5070: albers, 32610: utm}


def transformed(x: Column, y: Column, source: int, target: int) -> Point:
    """A point in another coordinate system."""
    return (x, y) if source == target else FROM_DEGREES[target](*TO_DEGREES[source](x, y))
