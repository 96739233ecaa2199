"""Cells of the globe: every point within one edge of its centre, measured on the sphere."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdgrid.functions import globe
from crowdgrid.functions.hexgrid import EARTH_RADIUS, edge_length
from crowdgrid.operators.hotspots import cell_counts, hotspots
from crowdgrid.operators.markers import heat_markers

SCHEMA = "lat_visit double, lon_visit double"


@pytest.fixture(scope="module")
def points(spark):
    r = random.Random(3)
    rows = [(math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for _ in range(4000)]
    for edge in (-90, -75, -74, -1, 0, 1, 30, 74, 75, 90):
        rows += [(max(-90.0, min(90.0, edge + d)), r.uniform(-180, 180)) for d in (-1e-3, -1e-9, 0.0, 1e-9, 1e-3)]
    rows += [(r.uniform(-90, 90), lon) for lon in (-180.0, 180.0, -179.9999, 179.9999, 0.0) for _ in range(200)]
    rows += [(s * (90 - r.random() * 16), r.uniform(-180, 180)) for s in (1, -1) for _ in range(500)]
    return spark.createDataFrame([(float(a), float(b)) for a, b in rows], SCHEMA).cache()


def metres(lat1, lon1, lat2, lon2):
    a, b, c, d = (np.radians(np.array(v, dtype=float)) for v in (lat1, lon1, lat2, lon2))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * EARTH_RADIUS * np.arcsin(np.sqrt(np.minimum(1, h)))


@pytest.mark.parametrize("resolution", [5, 7, 10, 13, 15])
def test_points_lie_within_one_edge_of_their_centre(points, resolution):
    rows = globe.with_center(globe.with_cell(points, resolution), resolution).collect()
    away = metres(*zip(*[(r.lat_visit, r.lon_visit, r.lat, r.lon) for r in rows]))
    assert away.max() <= edge_length(resolution) * (1 + 1e-6)
    assert away.max() >= 0.8 * edge_length(resolution)
    assert all(abs(r.lat) <= 90 and abs(r.lon) <= 180 for r in rows)


@pytest.mark.parametrize("resolution", [8, 10, 12])
def test_a_centre_in_its_zone_maps_back_to_its_cell(points, resolution):
    cells = globe.with_cell(points, resolution).select("cell").distinct()
    again = globe.with_cell(globe.with_center(cells, resolution), resolution, "lat", "lon", "back")
    same_zone = again.filter(globe.zone_of(F.col("cell")) == globe.zone_of(F.col("back")))
    assert same_zone.filter("cell <> back").count() == 0
    assert same_zone.count() > 0.9 * again.count()


@pytest.mark.parametrize("resolution", [6, 10])
def test_both_sides_of_the_antimeridian_share_their_cells(spark, resolution):
    r = random.Random(4)
    lats = [r.uniform(-90, 90) for _ in range(500)]
    both = [(i, lat, side) for i, lat in enumerate(lats) for side in (-180.0, 180.0)]
    df = spark.createDataFrame(both, "i int, lat_visit double, lon_visit double")
    placed = globe.with_cell(df, resolution).groupBy("i").agg(F.countDistinct("cell").alias("n"))
    assert placed.filter("n > 1").count() == 0
    near = [(lat, s * (180 - 1e-7)) for lat in lats if abs(lat) < 89 for s in (1, -1)]
    cells = globe.with_cell(spark.createDataFrame(near, SCHEMA), resolution).collect()
    pairs = list(zip(cells[::2], cells[1::2]))
    # Where rows of cells meet the antimeridian with an edge, the two sides differ.
    assert sum(a.cell == b.cell for a, b in pairs) > 0.5 * len(pairs)


def test_cells_have_the_area_of_their_resolution(spark):
    """Points spread evenly over small squares: how many cells they meet gives their area."""
    for lat in (0.5, 23.4, 45.5, 60.5, 74.2, 85.0, -33.5):
        size, n = 0.03, 160
        shrink = math.cos(math.radians(lat))
        grid = spark.range(n * n).selectExpr(
            f"{lat}D + (id div {n}) * {size / n}D AS lat_visit", f"12.0D + (id % {n}) * {size / n / shrink}D AS lon_visit"
        )
        cells = globe.with_cell(grid).select("cell").distinct().count()
        side = math.radians(size) * EARTH_RADIUS
        area = 1.5 * math.sqrt(3) * edge_length(10) ** 2
        assert 0.97 < cells * area / side**2 < 1.3


def test_no_two_cells_share_an_id(points):
    """Cells with one id have one centre, and different ids different centres."""
    for resolution in (5, 15):
        cells = globe.with_center(globe.with_cell(points, resolution).select("cell").distinct(), resolution)
        rows = cells.select("cell", F.round("lat", 9).alias("a"), F.round("lon", 9).alias("b")).collect()
        assert len({r.cell for r in rows}) == len(rows) and all(r.cell > 0 for r in rows)
        by_zone = {(r.cell >> 50 & 511, r.a, r.b) for r in rows}
        assert len(by_zone) == len(rows)


def test_null_coordinates_and_coarse_cells(spark, points):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (None, None)], SCHEMA)
    assert [r.cell for r in globe.with_cell(df).collect()] == [None] * 3
    with pytest.raises(ValueError):
        globe.with_cell(points, 4)
    with pytest.raises(ValueError):
        globe.with_cell(points, 16)


def test_reports_take_the_globe_as_their_grid(spark, points):
    visits = points.select(
        F.lit("d").alias("device_id"), F.lit("2024-01-05 10:00:00").alias("date_visit"), "lat_visit", "lon_visit"
    )
    counts = cell_counts(visits, place=globe.with_cell)
    assert counts.agg(F.sum("pings")).first()[0] == points.count()
    report = hotspots(visits, threshold=1, place=globe.with_cell)
    markers = heat_markers(report, center=globe.with_center)
    assert markers.count() == counts.count() and {"lat", "lon", "color"} <= set(markers.columns)


def test_cells_stay_in_generated_code(points):
    plan = globe.with_cell(points)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
