"""The Lambert conformal conic projection of North America (ESRI:102009) and its inverse, as Columns."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The GRS80 ellipsoid and the projection's parallels, origin and name.
MAJOR_AXIS = 6378137.0
INVERSE_FLATTENING = 298.257222101
PARALLELS = (20.0, 60.0)
ORIGIN = (-96.0, 40.0)
CRS_URN = "urn:ogc:def:crs:ESRI::102009"
SYSTEMS = ("wgs84", "esri:102009")

E2 = 2 / INVERSE_FLATTENING - INVERSE_FLATTENING**-2
E = math.sqrt(E2)


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)


def _t(phi: float) -> float:
    s = E * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (E / 2)


_P1, _P2 = (math.radians(p) for p in PARALLELS)
#: Cone constant, scale and the radius of the origin.
N = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
SCALE = MAJOR_AXIS * _m(_P1) / (N * _t(_P1) ** N)
RHO0 = SCALE * _t(math.radians(ORIGIN[1])) ** N


def to_lambert(lon: Column, lat: Column) -> Column:
    """struct(x, y) in metres."""
    phi = F.radians(lat)
    s = F.sin(phi) * F.lit(E)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(E / 2))
    rho = F.lit(SCALE) * F.pow(t, F.lit(N))
    theta = (F.radians(lon) - F.lit(math.radians(ORIGIN[0]))) * F.lit(N)
    return F.struct((rho * F.sin(theta)).alias("x"), (F.lit(RHO0) - rho * F.cos(theta)).alias("y"))


def from_lambert(x: Column, y: Column, steps: int = 6) -> Column:
    """struct(lon, lat) in degrees; the latitude by a fixed number of fixed-point steps."""
    below = F.lit(RHO0) - y
    rho = F.sqrt(x * x + below * below)
    t = F.pow(rho / F.lit(SCALE), F.lit(1 / N))
    phi = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t),
        lambda p, _: F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t * F.pow((1 - F.lit(E) * F.sin(p)) / (1 + F.lit(E) * F.sin(p)), F.lit(E / 2))),
    )
    lon = F.degrees(F.atan2(x, below)) / F.lit(N) + F.lit(ORIGIN[0])
    return F.struct(lon.alias("lon"), F.degrees(phi).alias("lat"))


def identity(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("x"), lat.cast("double").alias("y"))


def transform(system: str) -> Callable[[Column, Column], Column]:
    """The projection of a named coordinate system."""
    if system not in SYSTEMS:
        raise ValueError(f"Unsupported coordinate system: {system}")
    return identity if system == "wgs84" else to_lambert


def crs_name(system: str) -> str | None:
    return CRS_URN if system == "esri:102009" else None
