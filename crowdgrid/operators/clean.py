"""From decoded messages to clean visits; row-wise, so batch and stream share it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdgrid.functions.visits import epoch_to_text, mask_device_id, number, valid_position
from crowdgrid.schema import VISIT_SOURCE_FIELDS
from crowdgrid.sources.messages import decode


def clean(decoded: DataFrame, substitution: tuple[str, str] | None = None) -> DataFrame:
    """Keep rows with a usable position; hash the device and render the time as text."""
    positioned = decoded.select(
        "device_id",
        number(F.col("time_stamp")).alias("time_stamp"),
        number(F.col("lat_visit")).alias("lat_visit"),
        number(F.col("lon_visit")).alias("lon_visit"),
    ).filter(valid_position(F.col("lat_visit"), F.col("lon_visit")))
    return positioned.select(
        mask_device_id(F.col("device_id"), substitution).alias("device_id"),
        epoch_to_text(F.col("time_stamp")).alias("date_visit"),
        "lat_visit",
        "lon_visit",
    )


def visits_from_messages(
    messages: DataFrame, substitution: tuple[str, str] | None = None
) -> DataFrame:
    """Decode only the fields a visit needs, then clean."""
    return clean(decode(messages, VISIT_SOURCE_FIELDS), substitution)
