"""Marker tables: the rows a map draws."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdgrid.functions.hexgrid import with_center
from crowdgrid.functions.visits import heat_popup, journey_popup, marker_color
from crowdgrid.operators.hotspots import DEFAULT_RESOLUTION, Place


def heat_markers(
    report: DataFrame, resolution: int = DEFAULT_RESOLUTION, center: Place = with_center
) -> DataFrame:
    """One marker per row of the hotspot report, at the centre of its cell."""
    red = F.col("red_wave")
    return center(report, resolution).select(
        "cell",
        "hour",
        "date",
        "lat",
        "lon",
        marker_color(red).alias("color"),
        heat_popup(red, F.col("pings"), F.col("date"), F.col("hour")).alias("popup"),
    )


def journey_markers(visits: DataFrame) -> DataFrame:
    """One marker per visit. Row-wise: no order is needed to place a marker."""
    return visits.select(
        "device_id",
        "date_visit",
        F.col("lat_visit").alias("lat"),
        F.col("lon_visit").alias("lon"),
        journey_popup(F.col("device_id"), F.col("date_visit")).alias("popup"),
    )
