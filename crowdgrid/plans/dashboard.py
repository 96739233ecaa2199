"""The crowd dashboard: every table it shows, for a range of dates."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame

from crowdgrid.operators.clusters import is_empty
from crowdgrid.operators.hotspots import (
    DEFAULT_RESOLUTION,
    DEFAULT_SIGMA,
    RED_WAVE_THRESHOLD,
    cell_counts,
    date_range,
    with_flags,
)
from crowdgrid.operators.markers import heat_markers
from crowdgrid.operators.totals import cluster_distribution, hourly_from_counts, overview
from crowdgrid.session import materialise


def last_days(days: int = 7, today: date | None = None) -> tuple[str, str]:
    """The range from ``days`` ago to today in UTC, both included."""
    end = today or datetime.now(timezone.utc).date()
    return (end - timedelta(days=days)).isoformat(), end.isoformat()


def dashboard(
    visits: DataFrame,
    start: str | None = None,
    end: str | None = None,
    resolution: int = DEFAULT_RESOLUTION,
    sigma: int | float | str = DEFAULT_SIGMA,
    threshold: int = RED_WAVE_THRESHOLD,
) -> dict[str, DataFrame]:
    """Tables by name, or an empty dict where the range holds no visits.

    Without a range it is that of the last seven days.
    The cell counts are written once; the report, the markers and the hourly
    totals all start from them instead of from the visits.
    """
    first, last = last_days()
    chosen = date_range(visits, start or first, end or last)
    if is_empty(chosen):
        return {}
    counts = materialise(cell_counts(chosen, resolution))
    report = with_flags(counts, sigma, threshold)
    return {
        "report": report,
        "markers": heat_markers(report, resolution),
        "pings_by_hour": hourly_from_counts(counts).orderBy("date", "hour"),
        "clusters": cluster_distribution(chosen),
        "overview": overview(chosen),
    }
