"""Hexagonal cells: every point near its centre, every centre in its cell."""

import math
import random

import pytest
from pyspark.sql import functions as F

from crowdgrid.functions import hexgrid
from crowdgrid.operators.hotspots import hotspots
from crowdgrid.operators.markers import heat_markers


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(7)
    rows = [(rng.uniform(-85, 85), rng.uniform(-180, 180)) for _ in range(2000)]
    rows += [(53.55 + rng.uniform(-0.01, 0.01), -2.43 + rng.uniform(-0.01, 0.01)) for _ in range(2000)]
    return spark.createDataFrame(rows, "lat_visit double, lon_visit double")


def plane(lat, lon):
    c0 = math.cos(math.radians(hexgrid.STANDARD_PARALLEL))
    x = hexgrid.EARTH_RADIUS * math.radians(lon) * c0
    return x, hexgrid.EARTH_RADIUS * math.sin(math.radians(lat)) / c0


@pytest.mark.parametrize("resolution", [5, 10, 13])
def test_points_lie_within_one_edge_of_their_centre(points, resolution):
    placed = hexgrid.with_center(hexgrid.with_cell(points, resolution), resolution)
    edge = hexgrid.edge_length(resolution)
    for r in placed.collect():
        (x, y), (cx, cy) = plane(r.lat_visit, r.lon_visit), plane(r.lat, r.lon)
        assert math.hypot(x - cx, y - cy) <= edge * (1 + 1e-6)


@pytest.mark.parametrize("resolution", [7, 10, 12])
def test_a_centre_maps_back_to_its_cell(points, resolution):
    cells = hexgrid.with_cell(points, resolution).select("cell").distinct()
    centers = hexgrid.with_center(cells, resolution)
    again = hexgrid.with_cell(centers, resolution, lat="lat", lon="lon", name="back")
    assert again.filter("cell <> back").count() == 0


def test_no_other_centre_is_nearer(points):
    """Brute force over the six neighbours of each cell."""
    placed = hexgrid.with_cell(points.limit(300))
    axes = placed.select("*", hexgrid.axis_q(F.col("cell")).alias("q"),
                         hexgrid.axis_r(F.col("cell")).alias("r"))
    a = hexgrid.edge_length(10)

    def away(lat, lon, q, r):
        x, y = plane(lat, lon)
        return math.hypot(x - a * math.sqrt(3) * (q + r / 2), y - 1.5 * a * r)

    for p in axes.collect():
        own = away(p.lat_visit, p.lon_visit, p.q, p.r)
        for dq, dr in [(1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)]:
            assert own <= away(p.lat_visit, p.lon_visit, p.q + dq, p.r + dr) + 1e-6


def test_area_grows_sevenfold_per_step():
    area = [3 * math.sqrt(3) / 2 * hexgrid.edge_length(r) ** 2 for r in range(16)]
    assert area[10] == pytest.approx(15047.5)
    assert all(a / b == pytest.approx(7) for a, b in zip(area, area[1:]))


def test_null_coordinates_have_no_cell(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None)], "lat_visit double, lon_visit double")
    assert [r.cell for r in hexgrid.with_cell(df).collect()] == [None, None]


def test_poles_have_a_centre(spark):
    rows = [(90.0, 0.0), (-90.0, 180.0), (90.0, -180.0)]
    df = spark.createDataFrame(rows, "lat_visit double, lon_visit double")
    for resolution in (0, 10, 15):
        placed = hexgrid.with_center(hexgrid.with_cell(df, resolution), resolution)
        assert all(abs(r.lat) <= 90 for r in placed.collect())


def test_text_form(spark):
    df = spark.createDataFrame([(53.55, -2.4333)], "lat_visit double, lon_visit double")
    row = hexgrid.with_cell(df).select(
        hexgrid.cell_text(F.col("cell")).alias("t"),
        hexgrid.axis_q(F.col("cell")).alias("q"),
        hexgrid.axis_r(F.col("cell")).alias("r"),
    ).first()
    assert row.t == f"hx10:{row.q}:{row.r}" and row.q < 0 < row.r


def test_resolution_is_checked():
    with pytest.raises(ValueError):
        hexgrid.edge_length(16)


def test_cells_stay_in_generated_code(points):
    plan = hexgrid.with_cell(points)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
