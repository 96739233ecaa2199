"""Equal-area hexagonal cells as native column expressions.

The plane is a cylindrical equal-area projection with one standard parallel.
A cell is one ``bigint``: 4 bits of resolution, then 28 bits each for the axial
coordinates q and r, offset so that they are never negative. Grouping keys stay
eight bytes wide and nothing leaves generated code. The ids are not H3 ids. Cells do
not wrap at the antimeridian and stretch away from the standard parallel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Authalic earth radius in metres, default standard parallel in degrees,
# mean cell area in square metres at resolution 10, area ratio of neighbouring resolutions.
EARTH_RADIUS = 6371007.2
STANDARD_PARALLEL = 53.55
AREA_AT_10 = 15047.5
APERTURE = 7

RAD_PER_DEG = math.pi / 180.0
DEG_PER_RAD = 180.0 / math.pi
AXIS_BITS = 28
AXIS_OFFSET = 1 << (AXIS_BITS - 1)
AXIS_MASK = (1 << AXIS_BITS) - 1


def edge_length(resolution: int) -> float:
    """Hexagon edge in metres."""
    if not 0 <= resolution <= 15:
        raise ValueError("resolution must lie between 0 and 15")
    area = AREA_AT_10 * float(APERTURE) ** (10 - resolution)
    return math.sqrt(2.0 * area / (3.0 * math.sqrt(3.0)))


def factors(resolution: int, parallel: float = STANDARD_PARALLEL) -> dict[str, float]:
    """Constants that fold projection, scaling and axial rotation into three products.

    ``q = lon * q_lon - sin(lat) * q_lat`` and ``r = sin(lat) * r_lat``, before rounding.
    """
    a = edge_length(resolution)
    c0 = math.cos(math.radians(parallel))
    x_per_lon = EARTH_RADIUS * RAD_PER_DEG * c0
    y_per_sin = EARTH_RADIUS / c0
    return {
        "q_lon": x_per_lon * math.sqrt(3.0) / 3.0 / a,
        "q_lat": y_per_sin / 3.0 / a,
        "r_lat": y_per_sin * 2.0 / 3.0 / a,
        "lon_per_axis": a * math.sqrt(3.0) / x_per_lon,
        "sin_per_r": 1.5 * a / y_per_sin,
    }


def pack(q: Column, r: Column, resolution: int) -> Column:
    axes = F.shiftleft(q + F.lit(AXIS_OFFSET), AXIS_BITS).bitwiseOR(r + F.lit(AXIS_OFFSET))
    return axes.bitwiseOR(F.lit(resolution << (2 * AXIS_BITS)))


def axis_q(cell: Column) -> Column:
    return F.shiftright(cell, AXIS_BITS).bitwiseAND(F.lit(AXIS_MASK)) - F.lit(AXIS_OFFSET)


def axis_r(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit(AXIS_MASK)) - F.lit(AXIS_OFFSET)


def cell_text(cell: Column) -> Column:
    """Readable form ``hx<resolution>:<q>:<r>``."""
    return F.concat_ws(
        ":",
        F.concat(F.lit("hx"), F.shiftright(cell, 2 * AXIS_BITS).cast("string")),
        axis_q(cell).cast("string"),
        axis_r(cell).cast("string"),
    )


def with_cell(
    df: DataFrame,
    resolution: int = 10,
    lat: str = "lat_visit",
    lon: str = "lon_visit",
    parallel: float = STANDARD_PARALLEL,
    name: str = "cell",
) -> DataFrame:
    """Add the id of the hexagon that holds each point; NULL where a coordinate is NULL.

    Rounding follows the cube rule: round all three axes, then recompute the one
    that moved furthest so that they still add up to zero.
    """
    k = factors(resolution, parallel)
    sin_lat = F.sin(F.col(lat) * F.lit(RAD_PER_DEG))
    half = F.lit(0.5)
    raw = df.withColumns(
        {
            "_qf": F.col(lon) * F.lit(k["q_lon"]) - sin_lat * F.lit(k["q_lat"]),
            "_rf": sin_lat * F.lit(k["r_lat"]),
        }
    )
    near = raw.withColumns(
        {
            "_q": F.floor(F.col("_qf") + half),
            "_r": F.floor(F.col("_rf") + half),
            "_s": F.floor(half - F.col("_qf") - F.col("_rf")),
        }
    )
    off = near.withColumns(
        {
            "_dq": F.abs(F.col("_q") - F.col("_qf")),
            "_dr": F.abs(F.col("_r") - F.col("_rf")),
            "_ds": F.abs(F.col("_s") + F.col("_qf") + F.col("_rf")),
        }
    )
    q_moved = (F.col("_dq") > F.col("_dr")) & (F.col("_dq") > F.col("_ds"))
    r_moved = ~q_moved & (F.col("_dr") > F.col("_ds"))
    q = F.when(q_moved, -F.col("_r") - F.col("_s")).otherwise(F.col("_q"))
    r = F.when(r_moved, -F.col("_q") - F.col("_s")).otherwise(F.col("_r"))
    cell = pack(q, r, resolution).alias(name)
    return off.select(*[F.col(c) for c in df.columns if c != name], cell)


def with_center(
    df: DataFrame,
    resolution: int = 10,
    cell: str = "cell",
    parallel: float = STANDARD_PARALLEL,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Add the centre point of each cell; a centre beyond a pole is put on it."""
    k = factors(resolution, parallel)
    q, r = axis_q(F.col(cell)), axis_r(F.col(cell))
    sin_lat = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), r * F.lit(k["sin_per_r"])))
    return df.withColumns(
        {
            lat: F.asin(sin_lat) * F.lit(DEG_PER_RAD),
            lon: (q + r * F.lit(0.5)) * F.lit(k["lon_per_axis"]),
        }
    )
