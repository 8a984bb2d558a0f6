"""British National Grid to WGS84 longitude/latitude as closed-form column math.

Inverse transverse Mercator (published series, no iteration) on the Airy 1830 ellipsoid, the published
seven-parameter datum shift, then a closed-form cartesian-to-geodetic step. Good to about 5 m, the
accuracy of the seven-parameter shift itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Published ellipsoids (semi-axes in metres).
AIRY_1830 = (6377563.396, 6356256.909)
WGS84 = (6378137.0, 6356752.314245)

# Published National Grid projection.
SCALE = 0.9996012717
ORIGIN_LAT = 49.0
ORIGIN_LON = -2.0
ORIGIN_E = 400000.0
ORIGIN_N = -100000.0

# Published shift OSGB36 -> WGS84 (metres, arc seconds, parts per million).
SHIFT_M = (446.448, -125.157, 542.060)
TURN_SECONDS = (0.1502, 0.2470, 0.8421)
SCALE_PPM = -20.4894


def _rectified(lat: float, n: float) -> float:
    """Rectifying latitude: distance along the meridian as an angle, series in the third flattening."""
    return (
        lat
        - (3 * n / 2 - 9 * n**3 / 16) * math.sin(2 * lat)
        + (15 * n**2 / 16 - 15 * n**4 / 32) * math.sin(4 * lat)
        - (35 * n**3 / 48) * math.sin(6 * lat)
        + (315 * n**4 / 512) * math.sin(8 * lat)
    )


def bng_to_wgs84(df: DataFrame, easting: str, northing: str) -> DataFrame:
    """Add ``lon`` and ``lat`` in WGS84 degrees; NULL where a grid value is NULL."""
    a, b = AIRY_1830
    e2 = 1 - (b / a) ** 2
    n = (a - b) / (a + b)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    origin = _rectified(math.radians(ORIGIN_LAT), n)

    names = df.columns
    mu, foot, nu, rho, t2, d, eta2 = (F.col(f"__g_{n}") for n in ("mu", "foot", "nu", "rho", "t2", "d", "eta2"))

    # One projection per stage keeps each shared term computed once.
    out = df.withColumn("__g_mu", F.lit(origin) + (F.col(northing) - ORIGIN_N) / (SCALE * radius))
    out = out.withColumn(
        "__g_foot",
        mu
        + (3 * n / 2 - 27 * n**3 / 32) * F.sin(2 * mu)
        + (21 * n**2 / 16 - 55 * n**4 / 32) * F.sin(4 * mu)
        + (151 * n**3 / 96) * F.sin(6 * mu)
        + (1097 * n**4 / 512) * F.sin(8 * mu),
    )
    bulge = 1 - e2 * F.pow(F.sin(foot), 2)
    out = out.withColumns(
        {
            "__g_nu": a * SCALE / F.sqrt(bulge),
            "__g_rho": a * SCALE * (1 - e2) / F.pow(bulge, 1.5),
            "__g_t2": F.pow(F.tan(foot), 2),
        }
    )
    # Offset from the central meridian in units of the transverse radius of curvature.
    out = out.withColumns({"__g_d": (F.col(easting) - ORIGIN_E) / nu, "__g_eta2": nu / rho - 1})
    lat_series = (
        F.pow(d, 2) / 2
        - (5 + 3 * t2 + eta2 - 9 * t2 * eta2) * F.pow(d, 4) / 24
        + (61 + 90 * t2 + 45 * t2 * t2) * F.pow(d, 6) / 720
    )
    lon_series = (
        d
        - (nu / rho + 2 * t2) * F.pow(d, 3) / 6
        + (5 + 28 * t2 + 24 * t2 * t2) * F.pow(d, 5) / 120
        - (61 + 662 * t2 + 1320 * t2 * t2 + 720 * F.pow(t2, 3)) * F.pow(d, 7) / 5040
    )
    out = out.withColumns(
        {
            "__g_phi": foot - F.tan(foot) * nu / rho * lat_series,
            "__g_lam": F.lit(math.radians(ORIGIN_LON)) + lon_series / F.cos(foot),
        }
    )
    return _shift_to_wgs84(out, F.col("__g_phi"), F.col("__g_lam")).select(*names, "lon", "lat")


def _shift_to_wgs84(df: DataFrame, phi: Column, lam: Column) -> DataFrame:
    a, b = AIRY_1830
    e2 = 1 - (b / a) ** 2
    tx, ty, tz = SHIFT_M
    rx, ry, rz = (math.radians(s / 3600) for s in TURN_SECONDS)
    k = 1 + SCALE_PPM * 1e-6

    out = df.withColumn("__g_n", a / F.sqrt(1 - e2 * F.pow(F.sin(phi), 2)))
    n = F.col("__g_n")
    out = out.withColumns(
        {
            "__g_x": n * F.cos(phi) * F.cos(lam),
            "__g_y": n * F.cos(phi) * F.sin(lam),
            "__g_z": n * (1 - e2) * F.sin(phi),
        }
    )
    x, y, z = F.col("__g_x"), F.col("__g_y"), F.col("__g_z")
    out = out.withColumns(
        {
            "__g_x2": tx + k * x - rz * y + ry * z,
            "__g_y2": ty + rz * x + k * y - rx * z,
            "__g_z2": tz - ry * x + rx * y + k * z,
        }
    )
    a2, b2 = WGS84
    we2 = 1 - (b2 / a2) ** 2
    wep2 = (a2 / b2) ** 2 - 1
    x2, y2, z2 = F.col("__g_x2"), F.col("__g_y2"), F.col("__g_z2")
    out = out.withColumn("__g_p", F.sqrt(x2 * x2 + y2 * y2))
    out = out.withColumn("__g_q", F.atan2(z2 * a2, F.col("__g_p") * b2))
    q = F.col("__g_q")
    return out.withColumns(
        {
            "lat": F.degrees(
                F.atan2(
                    z2 + wep2 * b2 * F.pow(F.sin(q), 3),
                    F.col("__g_p") - we2 * a2 * F.pow(F.cos(q), 3),
                )
            ),
            "lon": F.degrees(F.atan2(y2, x2)),
        }
    )
