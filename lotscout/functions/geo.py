"""Korean unified grid (EPSG:5179) to WGS84, as plain column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Published EPSG:5179 parameters on the GRS80 ellipsoid.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
SCALE = 0.9996
ORIGIN_LATITUDE = 38.0
ORIGIN_LONGITUDE = 127.5
FALSE_EASTING = 1_000_000.0
FALSE_NORTHING = 2_000_000.0

_F = 1 / INVERSE_FLATTENING
_N = _F / (2 - _F)
RECTIFYING_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)

# Krueger series in the third flattening, to fourth order.
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def _origin_northing() -> float:
    """Scaled meridian arc from the equator to the grid's origin latitude."""
    phi = math.radians(ORIGIN_LATITUDE)
    e = math.sqrt(_F * (2 - _F))
    chi = math.asin(math.tanh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi))))
    arc = chi + sum(a * math.sin(2 * j * chi) for j, a in enumerate(ALPHA, 1))
    return SCALE * RECTIFYING_RADIUS * arc


ORIGIN_NORTHING = _origin_northing()


def _series(coefficients: tuple[float, ...], term) -> Column:
    first, *rest = (c * term(2 * j) for j, c in enumerate(coefficients, 1))
    return sum(rest, first)


def with_wgs84(
    df: DataFrame, x: str = "x", y: str = "y", longitude: str = "longitude", latitude: str = "latitude"
) -> DataFrame:
    """Replace grid coordinates by degrees; NULL when either coordinate is NULL.

    Each step is a projection of its own, so every angle is computed once per row, inside the
    generated code of the stage and without a Python worker.
    """
    xi, eta, xi_c, eta_c, chi = (F.col(f"_{n}") for n in ("xi", "eta", "xi_c", "eta_c", "chi"))
    steps = [
        {
            "_xi": (F.col(y) - FALSE_NORTHING + ORIGIN_NORTHING) / (SCALE * RECTIFYING_RADIUS),
            "_eta": (F.col(x) - FALSE_EASTING) / (SCALE * RECTIFYING_RADIUS),
        },
        {
            "_xi_c": xi - _series(BETA, lambda m: F.sin(m * xi) * F.cosh(m * eta)),
            "_eta_c": eta - _series(BETA, lambda m: F.cos(m * xi) * F.sinh(m * eta)),
        },
        {"_chi": F.asin(F.sin(xi_c) / F.cosh(eta_c))},
        {
            longitude: F.degrees(F.atan2(F.sinh(eta_c), F.cos(xi_c))) + ORIGIN_LONGITUDE,
            latitude: F.degrees(chi + _series(DELTA, lambda m: F.sin(m * chi))),
        },
    ]
    for step in steps:
        df = df.withColumns(step)
    return df.drop("_xi", "_eta", "_xi_c", "_eta_c", "_chi", x, y)
