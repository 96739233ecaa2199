"""Hexagonal cells over the whole globe, as native column expressions.

Between 75 degrees south and north every degree of latitude is a zone with an equal-area
cylinder about its middle; a cap about each pole lies on an equal-area disc. In a zone a whole
number of cells goes round the earth, so a cell at the antimeridian is the same from both
sides, and its edge is as much shorter than that of the resolution as the projection can
stretch within the zone: every point lies within one edge of the centre of its cell, measured
on the sphere. Cells are cut where zones meet. One ``bigint`` holds resolution, zone, column
and row; the ids differ from those of ``hexgrid``, whose functions these can stand in for.
"""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdgrid.functions.hexgrid import DEG_PER_RAD, EARTH_RADIUS, RAD_PER_DEG, edge_length

# Degrees of latitude where the caps begin.
CAP = 75
# Zones are numbered by the degree at their foot and this; the caps come after them.
ZONE_OFFSET = 90
NORTH, SOUTH = 180, 181
# Cells larger than a tenth of a zone would be cut too often.
LEAST_RESOLUTION = 5

ROW_BITS, COLUMN_BITS, ZONE_BITS = 24, 26, 9
ROW_OFFSET = 1 << (ROW_BITS - 1)
COLUMN_OFFSET = 1 << (COLUMN_BITS - 1)


def _stretch(foot: float, reach: float) -> float:
    """How far the cylinder about the middle of a zone can stretch, ``reach`` beyond it too."""
    middle = math.cos(math.radians(foot + 0.5))
    ends = [math.cos(math.radians(foot + d)) for d in (-reach, 1 + reach)]
    if foot < 0 < foot + 1 or foot in (0, -1):
        ends.append(1.0)
    return max(max(middle / e, e / middle) for e in ends)


@lru_cache(maxsize=16)
def zones(resolution: int) -> dict[str, list[float]]:
    """Constants of every zone, by its number: the sine at its foot, rows for a unit of sine,
    and columns round the earth; unused numbers hold those of the first zone."""
    edge = edge_length(resolution)
    if resolution < LEAST_RESOLUTION:
        raise ValueError(f"resolution must be {LEAST_RESOLUTION} at least")
    reach = math.degrees(edge / EARTH_RADIUS)
    found: dict[str, list[float]] = {"foot": [], "rows": [], "columns": []}
    for number in range(ZONE_OFFSET + CAP):
        foot = max(number - ZONE_OFFSET, -CAP)
        inner, middle = edge / _stretch(foot, reach), math.cos(math.radians(foot + 0.5))
        found["foot"].append(math.sin(math.radians(foot)))
        found["rows"].append(EARTH_RADIUS / middle / (1.5 * inner))
        found["columns"].append(
            float(math.ceil(2 * math.pi * EARTH_RADIUS * middle / (math.sqrt(3) * inner)))
        )
    return found


def cap_edge(resolution: int) -> float:
    """Edge of the cells of a cap, in metres."""
    reach = math.radians(90 - CAP) + edge_length(resolution) / EARTH_RADIUS
    return edge_length(resolution) * math.cos(reach / 2)


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Keep some columns and add others, each computed once: unpacking a row of an array is a
    border that no later expression is moved across."""
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def _constants(resolution: int, zone: Column) -> Column:
    """The constants of a zone; NULL for a cap."""
    of_zone = zip(*(zones(resolution)[n] for n in ("foot", "rows", "columns")))
    rows = [F.array(*[F.lit(v) for v in values]) for values in of_zone]
    return F.get(F.array(*rows), zone)


def with_cell(
    df: DataFrame,
    resolution: int = 10,
    lat: str = "lat_visit",
    lon: str = "lon_visit",
    name: str = "cell",
) -> DataFrame:
    """Add the id of the cell that holds each point; NULL where a coordinate is NULL."""
    given = [c for c in df.columns if c != name]
    zone = (
        F.when(F.col(lat) >= CAP, F.lit(NORTH))
        .when(F.col(lat) < -CAP, F.lit(SOUTH))
        .otherwise(F.floor(F.col(lat)).cast("int") + ZONE_OFFSET)
    )
    placed = _once(df, given, _zone=zone, _k=_constants(resolution, zone))

    # The antimeridian has one longitude.
    east = F.when(F.col(lon) >= 180, F.col(lon) - F.lit(360.0)).otherwise(F.col(lon))
    phi, turn = F.col(lat) * F.lit(RAD_PER_DEG), east * F.lit(RAD_PER_DEG)
    in_cap, k = F.col("_zone") >= NORTH, F.col("_k")
    # Unit steps of the cap: rows along y, and columns along x less half a row.
    unit = EARTH_RADIUS / cap_edge(resolution)
    rho = F.lit(2 * unit) * F.sin((F.lit(math.pi / 2) - F.abs(phi)) / 2)
    flat = _once(
        placed,
        [*given, "_zone"],
        _rf=F.when(in_cap, rho * F.cos(turn) * F.lit(2 / 3)).otherwise(
            (F.sin(phi) - F.get(k, F.lit(0))) * F.get(k, F.lit(1))
        ),
        _uf=F.when(in_cap, rho * F.sin(turn) * F.lit(1 / math.sqrt(3))).otherwise(
            east * F.get(k, F.lit(2)) / F.lit(360.0)
        ),
        _round=F.get(k, F.lit(2)).cast("bigint"),
    )

    half, rf = F.lit(0.5), F.col("_rf")
    qf = F.col("_uf") - rf * half
    near = _once(
        flat,
        [*given, "_zone", "_round", "_rf"],
        _qf=qf,
        _q=F.floor(qf + half),
        _r=F.floor(rf + half),
        _s=F.floor(half - qf - rf),
    )
    q, r, s, qf = (F.col(c) for c in ("_q", "_r", "_s", "_qf"))
    off_q, off_r, off_s = F.abs(q - qf), F.abs(r - rf), F.abs(s + qf + rf)
    q_moved = (off_q > off_r) & (off_q > off_s)
    r_moved = ~q_moved & (off_r > off_s)
    axes = _once(
        near,
        [*given, "_zone", "_round"],
        _q=F.when(q_moved, -r - s).otherwise(q),
        _r=F.when(r_moved, -q - s).otherwise(r),
    )
    column = F.when(in_cap, q + F.lit(COLUMN_OFFSET)).otherwise(F.pmod(q, F.col("_round")))
    cell = F.lit(resolution << (ROW_BITS + COLUMN_BITS + ZONE_BITS)).bitwiseOR(
        F.shiftleft(F.col("_zone").cast("bigint"), ROW_BITS + COLUMN_BITS)
        .bitwiseOR(F.shiftleft(column, ROW_BITS))
        .bitwiseOR(r + F.lit(ROW_OFFSET))
    )
    return _once(axes, given, **{name: cell})


def zone_of(cell: Column) -> Column:
    zone = F.shiftright(cell, ROW_BITS + COLUMN_BITS).bitwiseAND(F.lit((1 << ZONE_BITS) - 1))
    return zone.cast("int")


def with_center(
    df: DataFrame, resolution: int = 10, cell: str = "cell", lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Add the centre point of each cell; a centre beyond a pole is put on it."""
    given = [c for c in df.columns if c not in (lat, lon)]
    column = F.shiftright(F.col(cell), ROW_BITS).bitwiseAND(F.lit((1 << COLUMN_BITS) - 1))
    cut = _once(
        df,
        given,
        _zone=zone_of(F.col(cell)),
        _k=_constants(resolution, zone_of(F.col(cell))),
        _row=F.col(cell).bitwiseAND(F.lit((1 << ROW_BITS) - 1)) - F.lit(ROW_OFFSET),
        _column=column,
    )
    edge, r, k, in_cap = cap_edge(resolution), F.col("_row"), F.col("_k"), F.col("_zone") >= NORTH
    along = F.col("_column") + r * F.lit(0.5)
    flat = _once(
        cut,
        [*given, "_zone"],
        _x=(along - F.lit(COLUMN_OFFSET)) * F.lit(math.sqrt(3) * edge),
        _y=r * F.lit(1.5 * edge),
        _sine=F.get(k, F.lit(0)) + r / F.get(k, F.lit(1)),
        _turn=along / F.get(k, F.lit(2)),
    )
    x, y = F.col("_x"), F.col("_y")
    rho = F.sqrt(x * x + y * y)
    from_pole = F.asin(F.least(F.lit(1.0), rho / F.lit(2 * EARTH_RADIUS))) * F.lit(2 * DEG_PER_RAD)
    north = F.when(F.col("_zone") == NORTH, F.lit(1.0)).otherwise(F.lit(-1.0))
    sine = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("_sine")))
    turned = (F.pmod(F.col("_turn") + F.lit(0.5), F.lit(1.0)) - F.lit(0.5)) * F.lit(360.0)
    return _once(
        flat,
        given,
        **{
            lat: F.when(in_cap, north * (F.lit(90.0) - from_pole)).otherwise(
                F.asin(sine) * F.lit(DEG_PER_RAD)
            ),
            lon: F.when(in_cap, F.atan2(x, y) * F.lit(DEG_PER_RAD)).otherwise(turned),
        },
    )
