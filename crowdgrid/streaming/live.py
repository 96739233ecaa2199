"""Live hourly cell counts, in place of querying the table again and again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from crowdgrid.functions.hexgrid import with_cell
from crowdgrid.functions.visits import visit_time
from crowdgrid.operators.hotspots import DEFAULT_RESOLUTION, Place


def live_counts(
    visits: DataFrame,
    resolution: int = DEFAULT_RESOLUTION,
    lateness: str = "1 hour",
    place: Place = with_cell,
) -> DataFrame:
    """Pings per (cell, hour, date) with a watermark; rows without a position count nowhere.

    In append mode an hour appears once, when it can no longer change; in update
    mode it appears whenever it grows. State is one counter per open hour and cell,
    and tasks combine before the shuffle.
    """
    placed = visits.filter(F.col("lat_visit").isNotNull() & F.col("lon_visit").isNotNull())
    # A watermark needs an instant: the one at which UTC clocks show the time of the visit.
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", start, visit_time(F.col("date_visit")))
    timed = place(placed, resolution).withColumn("event_ts", F.timestamp_micros(micros))
    counted = (
        timed.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 hour"), "cell")
        .agg(F.count(F.lit(1)).alias("pings"))
    )
    hours = F.floor(F.unix_seconds("window.start") / 3600)
    return counted.select(
        "cell",
        F.pmod(hours, F.lit(24)).cast("int").alias("hour"),
        F.date_from_unix_date(F.floor(hours / 24).cast("int")).alias("date"),
        "pings",
    )


def watch_counts(
    counts: DataFrame,
    callback: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Hand every count that changed to ``callback``, open hours included.

    The callback replaces the rows it stored under the same (cell, hour, date).
    """
    writer = (
        counts.writeStream.outputMode("update")
        .foreachBatch(callback)
        .option("checkpointLocation", checkpoint)
    )
    return _started(writer, once, interval)


def store_counts(
    counts: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = "10 seconds"
) -> StreamingQuery:
    """Append closed hours to a table; the batch flags run over that table."""
    writer = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date")
    )
    return _started(writer, once, interval)


def _started(writer: DataStreamWriter, once: bool, interval: str) -> StreamingQuery:
    timing = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**timing).start()
