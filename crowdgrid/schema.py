"""Fixed schemas of the wire message, the clean visit and the stored visit."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the wire message as the consumer decodes them.
MESSAGE_FIELDS = [
    "device_id",
    "timezone_visit",
    "day_of_week_visit",
    "time_stamp",
    "lat_visit",
    "date_visit",
    "time_visit",
    "lon_visit",
]

# The fields a clean visit is made from; the others are carried on the wire only.
VISIT_SOURCE_FIELDS = ["device_id", "time_stamp", "lat_visit", "lon_visit"]

VISIT_COLUMNS = ["device_id", "date_visit", "lat_visit", "lon_visit"]

CLUSTERED_COLUMNS = ["device_id", "date_visit", "lat_visit", "lon_visit", "cluster_pred"]


def message_schema(fields: list[str] | None = None) -> T.StructType:
    """Every wire field is read as nullable text, numbers included."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields or MESSAGE_FIELDS])


STORED_VISIT_SCHEMA = T.StructType(
    [
        T.StructField("device_id", T.StringType(), True),
        T.StructField("date_visit", T.StringType(), True),
        T.StructField("lat_visit", T.DoubleType(), True),
        T.StructField("lon_visit", T.DoubleType(), True),
        T.StructField("cluster_pred", T.IntegerType(), True),
        T.StructField("visit_date", T.DateType(), True),
        T.StructField("batch_id", T.LongType(), True),
    ]
)
