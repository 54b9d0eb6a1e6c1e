"""Longitude / latitude to UTM zone 12N (NAD83) as column arithmetic.

Transverse Mercator by the Krueger series to sixth order in the third
flattening, as published in Karney, "Transverse Mercator with an accuracy of a
few nanometers", J. Geodesy 85 (2011). NAD83 and WGS84 are taken as the same
datum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# GRS80 ellipsoid and UTM zone 12 north.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
SCALE = 0.9996
CENTRAL_MERIDIAN = -111.0
FALSE_EASTING = 500000.0
SRID = 26912

_N = FLATTENING / (2 - FLATTENING)
_E = 2 * math.sqrt(_N) / (1 + _N)
_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)

# Series coefficients, one row per harmonic, powers n**j upward.
_ALPHA_TERMS = (
    (1, (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800)),
    (2, (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360)),
    (3, (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440)),
    (4, (49561 / 161280, -179 / 168, 6601661 / 7257600)),
    (5, (34729 / 80640, -3418889 / 1995840)),
    (6, (212378941 / 319334400,)),
)
ALPHA = [sum(c * _N ** (j + i) for i, c in enumerate(cs)) for j, cs in _ALPHA_TERMS]


def with_utm(df: DataFrame, lon: Column, lat: Column, x: str = "utm_x", y: str = "utm_y") -> DataFrame:
    """Add easting and northing in metres; NULL where a coordinate is NULL.

    A positive longitude is taken for a missing sign. The work is split over
    several projections so that shared terms are computed once per row.
    """
    kept = [c for c in df.columns if c not in (x, y)]
    west = F.when(lon > 0, -lon).otherwise(lon)
    df = df.withColumns(
        {
            "_dlon": F.radians(west - F.lit(CENTRAL_MERIDIAN)),
            "_sin": F.sin(F.radians(lat)),
        }
    )
    df = df.withColumn("_t", F.sinh(F.atanh("_sin") - F.atanh(F.col("_sin") * _E) * _E))
    df = df.withColumns(
        {
            "_xi": F.atan2("_t", F.cos("_dlon")),
            "_eta": F.asinh(F.sin("_dlon") / F.hypot("_t", F.cos("_dlon"))),
        }
    )
    northing, easting = F.col("_xi"), F.col("_eta")
    for j, a in enumerate(ALPHA, start=1):
        xi, eta = F.col("_xi") * (2 * j), F.col("_eta") * (2 * j)
        northing = northing + F.sin(xi) * F.cosh(eta) * a
        easting = easting + F.cos(xi) * F.sinh(eta) * a
    point = F.struct(
        (easting * (SCALE * _RADIUS) + FALSE_EASTING).alias(x),
        (northing * (SCALE * _RADIUS)).alias(y),
    )
    # A generator's output cannot be substituted into the filters and projections
    # above it. As plain columns the series would be repeated per mention.
    return df.select(*kept, F.inline(F.array(point)))
