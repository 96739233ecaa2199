"""The map of one device: where it starts, its markers and its path."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crowdgrid.operators.clusters import is_empty
from crowdgrid.operators.journeys import device_visits, first_visits, journey, journey_paths
from crowdgrid.operators.markers import journey_markers


def device_map(visits: DataFrame, device_id: str) -> dict[str, DataFrame]:
    """Tables by name, or an empty dict where the device was never seen."""
    own = device_visits(visits, device_id)
    if is_empty(own):
        return {}
    return {
        "start": first_visits(own),
        "visits": journey(own, device_id),
        "markers": journey_markers(own),
        "path": journey_paths(own),
    }
