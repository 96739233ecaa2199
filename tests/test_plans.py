"""The end-to-end plans behind the dashboard and the device map."""

import datetime

import pytest

from crowdgrid.operators import hotspots
from crowdgrid.plans.dashboard import dashboard, last_days
from crowdgrid.plans.device_map import device_map
from crowdgrid.plans.queries import DEVICE_HASH
from crowdgrid.session import scratch
from crowdgrid.sources import tables
from crowdgrid.sources.testtables import event_visits, read_table


@pytest.fixture(scope="module")
def visits(spark, sf_dir):
    path = scratch(spark, "plans")
    tables.append(event_visits(read_table(spark, sf_dir, "events")), path)
    return spark.read.parquet(path)


def test_dashboard(visits):
    shown = dashboard(visits, "2024-01-05", "2024-01-12", threshold=1)
    total = hotspots.date_range(visits, "2024-01-05", "2024-01-12").count()
    assert shown["overview"].first().total == total > 0
    assert shown["markers"].count() == shown["report"].count() > 0
    assert sum(r.pings for r in shown["pings_by_hour"].collect()) == total
    assert shown["clusters"].count() == 5


def test_dashboard_without_visits(visits):
    assert dashboard(visits, "1999-01-01", "1999-01-02") == {}
    assert dashboard(visits) == {}


def test_last_days():
    assert last_days(today=datetime.date(2024, 3, 3)) == ("2024-02-25", "2024-03-03")


def test_device_map(visits):
    device = visits.groupBy("device_id").count().orderBy("count", ascending=False).first()
    shown = device_map(visits, device.device_id)
    ordered = shown["visits"].collect()
    assert len(ordered) == device["count"] == shown["markers"].count()
    assert [r.date_visit for r in ordered] == sorted(r.date_visit for r in ordered)
    start = shown["start"].first()
    assert (start.lat_visit, start.lon_visit) == (ordered[0].lat_visit, ordered[0].lon_visit)
    (path,) = shown["path"].collect()
    assert [p.lat for p in path.path] == [r.lat_visit for r in ordered]


def test_unknown_device(visits):
    assert device_map(visits, DEVICE_HASH[::-1]) == {}
