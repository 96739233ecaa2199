"""Visits derived from the supplied ``events`` table."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdgrid.functions.visits import mask_device_id
from crowdgrid.sources.messages import encode

# Rows of a streamed file, about.
FILE_ROWS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stream_table(
    spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None
) -> DataFrame:
    """The same file as a stream source."""
    schema = read_table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(sf_dir)


def stream_in_parts(
    spark: SparkSession, df: DataFrame, path: str, parts: int, file_rows: int = FILE_ROWS
) -> DataFrame:
    """The whole of ``df`` written as files and streamed in ``parts`` batches of as many files.

    A batch has a file for every ``file_rows`` of its rows, so that its tasks grow with it.
    Where that is more than one, rows are dealt in turn: repeated ones do not meet in a file.
    """
    files = max(1, -(-df.count() // (parts * file_rows)))
    dealt = df.repartition(parts, *df.columns) if files == 1 else df.repartition(parts * files)
    dealt.write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def event_pings(events: DataFrame, grouped: bool = False) -> DataFrame:
    """One typed ping per event, with the field names of the wire message.

    ``grouped`` pings stand in five clearly separated places, by ``user_id % 5``. Times are
    those of ``ts`` read as UTC, whatever the session's time zone.
    """
    lat, lon = (_grouped_latitude(), _grouped_longitude()) if grouped else (_latitude(), _longitude())
    text = F.col("ts").cast("string")
    return events.select(
        _device_id(),
        F.lit("UTC+0").alias("timezone_visit"),
        F.date_format(F.col("ts").cast("date"), "EEEE").alias("day_of_week_visit"),
        (_epoch_micros() / F.lit(1e6)).alias("time_stamp"),
        lat,
        F.substring(text, 1, 10).alias("data_visit"),
        F.substring(text, 12, 8).alias("time_visit"),
        lon,
    )


def event_messages(events: DataFrame, grouped: bool = False) -> DataFrame:
    """Events as JSON messages."""
    return encode(event_pings(events, grouped))


def event_visits(events: DataFrame, grouped: bool = False) -> DataFrame:
    """Events as stored visits, ``user_id % 5`` standing in for the cluster number.

    ``visit_date`` comes straight from ``ts``, so a range on it reaches the scan.
    """
    position = [_grouped_latitude(), _grouped_longitude()] if grouped else [_latitude(), _longitude()]
    return events.select(
        mask_device_id(_device_id()).alias("device_id"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("date_visit"),
        *position,
        (F.col("user_id") % 5).cast("int").alias("cluster_pred"),
        F.col("ts").cast("date").alias("visit_date"),
    )


def event_labellings(events: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Positions of all events with the columns ``k2``, ``k3`` ...: ``user_id`` modulo k."""
    return events.select(
        _latitude(), _longitude(), *[(F.col("user_id") % k).alias(f"k{k}") for k in ks]
    )


def _device_id() -> Column:
    number = F.lpad(F.col("user_id").cast("string"), 9, "0")
    return F.concat(F.lit("+447"), number).alias("device_id")


def _epoch_micros() -> Column:
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", start, F.col("ts"))


def _grouped_latitude() -> Column:
    offset = (F.col("event_id") % 7) * F.lit(0.001)
    return (F.lit(50.0) + (F.col("user_id") % 5) * F.lit(1.0) + offset).alias("lat_visit")


def _grouped_longitude() -> Column:
    offset = (F.col("event_id") % 11) * F.lit(0.001)
    return (F.lit(-3.0) + (F.col("user_id") % 5) * F.lit(0.75) + offset).alias("lon_visit")


def _latitude() -> Column:
    return (F.lit(53.55) + (F.col("user_id") % 20 - 10) * F.lit(0.001)).alias("lat_visit")


def _longitude() -> Column:
    return (F.lit(-2.4333) + (F.col("event_id") % 7 - 3) * F.lit(0.0017)).alias("lon_visit")
