"""Journeys against brute force in Python, with and without busy devices."""

import random
from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from crowdgrid.operators import journeys, markers
from crowdgrid.sources.tables import register_view

SCHEMA = "device_id string, date_visit string, lat_visit double, lon_visit double, cluster_pred int"


def fixture_rows():
    """One device holds a third of the rows, many of them identical or without a time."""
    rng = random.Random(11)

    def visit(device):
        at = rng.choice([None, *[f"2024-01-0{d} 0{h}:00:00" for d in (1, 2) for h in (1, 5, 9)]])
        return (device, at, rng.choice([1.0, 2.0, 3.0]), rng.choice([5.0, 6.0]), 0)

    rows = [visit("busy") for _ in range(200)]
    rows += [("busy", None, 1.0, 5.0, 0)] * 100
    rows += [visit(f"d{i % 60}") for i in range(400)]
    rows += [("single", "2024-01-01 01:00:00", 1.0, 1.0, 0)]
    rows += [(None, "2024-01-01 01:00:00", 1.0, 1.0, 0)] * 50
    return rows


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA).repartition(8).cache()


def key(point):
    return (point[0] is not None, point[0] or "", point[1], point[2])


def expected():
    out = {}
    known = sorted((r for r in fixture_rows() if r[0] is not None), key=lambda r: r[0])
    for device, rows in groupby(known, key=lambda r: r[0]):
        points = Counter(r[1:4] for r in rows)
        out[device] = [(*p, points[p]) for p in sorted(points, key=key)]
    return out


SIZES = [{}, {"busy_visits": 100, "block_visits": 40}, {"busy_visits": 5, "block_visits": 7}]


@pytest.mark.parametrize("sizes", SIZES)
def test_points_and_positions(visits, sizes):
    got = {}
    for r in journeys.ordered_points(visits, **sizes).orderBy("device_id", "pos").collect():
        got.setdefault(r.device_id, []).append(
            (r.pos, (r.date_visit, r.lat_visit, r.lon_visit, r.pings), r.after)
        )
    want = expected()
    assert got.keys() == want.keys()
    for device, points in want.items():
        assert [p for p, _, _ in got[device]] == list(range(1, len(points) + 1))
        assert [row for _, row, _ in got[device]] == points
        following = [tuple(a) if a else None for _, _, a in got[device]]
        assert following == [p[:3] for p in points[1:]] + [None]


@pytest.mark.parametrize("sizes", SIZES)
def test_segments(visits, sizes):
    segments = journeys.journey_segments(visits, **sizes)
    per_device = {r.device_id: r["count"] for r in segments.groupBy("device_id").count().collect()}
    assert per_device == {d: len(p) - 1 for d, p in expected().items() if len(p) > 1}


def test_no_visit_is_lost(visits):
    points = journeys.ordered_points(visits, busy_visits=5, block_visits=7)
    assert points.agg(F.sum("pings")).first()[0] == visits.filter("device_id is not null").count()


@pytest.mark.parametrize("sizes", SIZES)
def test_paths(visits, sizes):
    got = {}
    for r in journeys.journey_paths(visits, 4, **sizes).orderBy("device_id", "part").collect():
        got.setdefault(r.device_id, []).append([tuple(p) for p in r.path])
    for device, points in expected().items():
        assert all(len(part) == 4 for part in got[device][:-1])
        flat = [p for part in got[device] for p in part]
        assert flat == [(lat, lon, n) for _, lat, lon, n in points]


def test_first_visits(visits):
    got = {r.device_id: tuple(r)[1:] for r in journeys.first_visits(visits).collect()}
    assert got == {d: p[0][:3] for d, p in expected().items()}


def test_one_device_in_order(spark, visits):
    rows = [tuple(r)[1:4] for r in journeys.journey(visits, "busy").collect()]
    assert rows == sorted((r[1:4] for r in fixture_rows() if r[0] == "busy"), key=key)
    register_view(visits, "journey_test")
    again = journeys.journey_sql(spark, "busy", "journey_test").collect()
    assert [(r.date_visit, r.lat_visit, r.lon_visit) for r in again] == rows
    assert journeys.journey(visits, "nobody").isEmpty()
    assert journeys.journey_sql(spark, "x' OR '1'='1", "journey_test").isEmpty()


def test_quiet_devices_move_once(visits):
    plan = journeys.ordered_points(visits)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


@pytest.mark.parametrize("sizes", SIZES)
def test_the_input_is_read_twice_at_most(spark, sizes):
    rows = spark.createDataFrame(fixture_rows(), SCHEMA).repartition(4)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    journeys.journey_segments(rows.mapInArrow(counted, SCHEMA), **sizes).collect()
    assert read.value <= 2 * len(fixture_rows())


def test_markers(visits):
    rows = markers.journey_markers(journeys.device_visits(visits, "single")).collect()
    assert [r.popup for r in rows] == [
        "<b>Device ID:</b> single<br><b>Date:</b> 2024-01-01 01:00:00<br>"
    ]
    late = markers.journey_markers(visits.filter("device_id = 'busy' and date_visit is null"))
    assert late.first().popup == "<b>Device ID:</b> busy<br><b>Date:</b> None<br>"
    unknown = visits.limit(1).withColumn("device_id", F.lit(None).cast("string"))
    assert markers.journey_markers(unknown).first().popup.startswith("<b>Device ID:</b> None<br>")
