"""The stored visit table: appending, idempotent micro-batch writes, scans and views.

Micro-batches land in the folder of the table, each in its own (visit_date, batch_id)
partitions. ``compact`` publishes closed batches as segments, partitioned by date only, in a
folder below that plain reads of the table pass over. The log of segments has numbered
entries, each with all segments that count from then on; landed batches that a segment holds
no longer do. An entry is created only where none has its number, so of two compactions that
start from the same entry one is published, and the other starts again or joins it. ``tidy``
removes what no longer counts.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdgrid.schema import STORED_VISIT_SCHEMA
from crowdgrid.sources import files, kept

VIEW_NAME = "visits"

# Folders below a table whose names plain reads of it pass over.
SEGMENTS = "_segments"
SEGMENT_LOG = "_segment_log"

# Tries of a compaction that others overtake, and hours after which files of a compaction
# that was never published are taken for left over.
TRIES = 10
LEFT_OVER_HOURS = 24

# Lookups of one device skip the row groups whose filter rules it out; the adaptive
# filter is no larger than its devices need.
DEVICE_INDEX = kept.BLOOM


def with_visit_date(df: DataFrame) -> DataFrame:
    """Add the calendar date of ``date_visit``, the partition column of the table."""
    return df.withColumn("visit_date", F.substring("date_visit", 1, 10).try_cast("date"))


def append(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> None:
    """Append rows; files are partitioned by date, other connectors take the rows as they are."""
    dated = df if "visit_date" in df.columns else with_visit_date(df)
    if path is None:
        dated.write.format(fmt).options(**(options or {})).mode("append").save()
        return
    writer = _laid_out(dated, "visit_date").write.format(fmt)
    writer = writer.options(**DEVICE_INDEX, **(options or {}))
    writer.mode("append").partitionBy("visit_date").save(path)


def _laid_out(dated: DataFrame, *partitions: str) -> DataFrame:
    """Rows of a date together, split where a date is crowded, each file sorted by device."""
    return dated.hint("rebalance", "visit_date").sortWithinPartitions(*partitions, "device_id")


def write_batch(
    df: DataFrame,
    batch_id: int,
    path: str,
    fmt: str = "parquet",
    keep: tuple[str, ...] = (),
) -> None:
    """Write one micro-batch so that writing it again replaces it.

    A batch owns its (visit_date, batch_id) partitions; the same offsets give the
    same dates, so a replay overwrites exactly what the first try left behind. A replay of
    a published batch writes nothing, as its rows are there. A stream that starts with a
    new checkpoint numbers its batches anew and therefore needs a new table.

    ``keep`` names tables of ``kept`` that follow from the batch: they are made from its
    files, so the batch itself is not computed again.
    """
    spark = df.sparkSession
    done = segments(spark, path).done
    if done is not None and batch_id <= done:
        return
    owned = with_visit_date(df).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    (
        _laid_out(owned, "visit_date", "batch_id")
        .write.format(fmt)
        .options(**DEVICE_INDEX)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("visit_date", "batch_id")
        .save(path)
    )
    if keep:
        written = list(files.matching(spark, os.path.join(path, f"visit_date=*/batch_id={batch_id}")))
        stored = spark.read.format(fmt).schema(STORED_VISIT_SCHEMA).option("basePath", path)
        rows = stored.load(written) if written else spark.createDataFrame([], STORED_VISIT_SCHEMA)
        kept.write_landed(rows, batch_id, path, keep)


@dataclass(frozen=True)
class Segments:
    """An entry of the log: its number, the segments that count (first batch, last batch,
    folder), and the folders of those that no longer do."""

    version: int = 0
    live: tuple[tuple[int, int, str], ...] = ()
    dropped: tuple[str, ...] = ()

    @property
    def done(self) -> int | None:
        """The last published batch."""
        return self.live[-1][1] if self.live else None


def segments(spark: SparkSession, path: str) -> Segments:
    """The last entry of the log."""
    log = os.path.join(path, SEGMENT_LOG)
    numbers = [int(os.path.basename(p)) for p in files.matching(spark, os.path.join(log, "[0-9]*"))]
    if not numbers:
        return Segments()
    entry = json.loads(files.read_text(spark, os.path.join(log, f"{max(numbers):08d}")))
    return Segments(max(numbers), tuple(map(tuple, entry["live"])), tuple(entry["dropped"]))


def compact(
    spark: SparkSession,
    path: str,
    through: int | None = None,
    full: bool = False,
    stopped: bool = False,
) -> int | None:
    """Publish the landed batches up to ``through`` as one segment partitioned by date.

    By default that is every batch but the latest, which may still be written; the latest is
    published only where the caller says that the stream has ``stopped``. With ``full`` the
    earlier segments are merged in, so that the number of files depends on the dates alone.
    Several compactions may run at once, and a failed one is simply run again. Returns the
    last batch that is published, or None.
    """
    for _ in range(TRIES):
        known = segments(spark, path)
        planned = _plan(spark, path, known, through, full, stopped)
        if planned is None:
            return known.done
        low, high, merged, rows = planned
        folder = f"{low}-{high}-{uuid.uuid4().hex[:8]}"
        target = os.path.join(path, SEGMENTS, folder)
        writer = _laid_out(rows, "visit_date").write.options(**DEVICE_INDEX).mode("overwrite")
        writer.partitionBy("visit_date").option("partitionOverwriteMode", "static").parquet(target)
        batches = [b for b in landed_batches(spark, path, known.done) if b <= high]
        kept.write_segment(spark, path, folder, batches, merged)
        if _publish(spark, path, known, (low, high, folder), merged):
            return high
        files.delete(spark, target)
        kept.tidy(spark, path, -1, [folder])
    raise RuntimeError(f"{TRIES} compactions of {path} were overtaken by others")


def _plan(
    spark: SparkSession,
    path: str,
    known: Segments,
    through: int | None,
    full: bool,
    stopped: bool,
) -> tuple[int, int, list[str], DataFrame] | None:
    """First and last batch of the next segment, the folders it merges, and its rows."""
    batches = landed_batches(spark, path, known.done)
    latest = batches[-1] if batches else None
    if through is not None and latest is not None and through >= latest and not stopped:
        raise ValueError(f"batch {latest} may still be written; say that the stream has stopped")
    last = through if through is not None else latest if stopped or not batches else latest - 1
    closed = [b for b in batches if b <= last]
    if not closed and not (full and len(known.live) > 1):
        return None
    low, high = (closed[0], closed[-1]) if closed else known.live[0][:2]
    rows = []
    if closed:
        landed = _landed(spark, path, "parquet", known.done)
        rows.append(landed.filter(F.col("batch_id") <= high))
    merged = []
    if full and known.live:
        rows += [_published(spark, path, folder) for _, _, folder in known.live]
        merged = [folder for _, _, folder in known.live]
        low, high = known.live[0][0], max(high, known.done)
    return low, high, merged, reduce(DataFrame.unionByName, rows)


def _publish(
    spark: SparkSession,
    path: str,
    known: Segments,
    segment: tuple[int, int, str],
    merged: list[str],
) -> bool:
    """Add an entry with the segment; False where others have published what it holds."""
    low, high, _ = segment
    while True:
        kept = [s for s in known.live if s[2] not in merged]
        gone = len(kept) + len(merged) != len(known.live)
        if gone or any(first <= high and last >= low for first, last, _ in kept):
            return False
        live, dropped = sorted([*kept, segment]), [*known.dropped, *merged]
        number = os.path.join(path, SEGMENT_LOG, f"{known.version + 1:08d}")
        if files.create_new(spark, number, json.dumps({"live": live, "dropped": dropped})):
            return True
        known = segments(spark, path)


def tidy(spark: SparkSession, path: str, left_over_hours: float = LEFT_OVER_HOURS) -> int:
    """Remove published batches from the landing folder, merged segments, and segments that
    no compaction published for some hours.

    Call it when no reader that started before the last compaction is left. Returns the
    number of folders removed.
    """
    known = segments(spark, path)
    if not known.live:
        return 0

    def name(folder: str) -> str:
        return os.path.basename(folder)

    landed = files.matching(spark, os.path.join(path, "visit_date=*/batch_id=*"))
    gone = [f for f in landed if int(name(f).split("=")[1]) <= known.done]
    live, old = {s[2] for s in known.live}, (time.time() - 3600 * left_over_hours) * 1000
    folders = [
        folder
        for folder, changed in files.matching(spark, os.path.join(path, SEGMENTS, "*")).items()
        if name(folder) not in live and (name(folder) in known.dropped or changed < old)
    ]
    removed = sum(files.delete(spark, f) for f in gone + folders)
    kept.tidy(spark, path, known.done, [name(f) for f in folders])
    return removed


def landed_batches(spark: SparkSession, path: str, done: int | None) -> list[int]:
    """The landed batches after the last published one, from the names of their folders."""
    found = files.matching(spark, os.path.join(path, "visit_date=*/batch_id=*"))
    batches = {int(os.path.basename(f).split("=")[1]) for f in found}
    return sorted(b for b in batches if done is None or b > done)


def _kept(spark: SparkSession, path: str, name: str, condition: Column | None = None) -> DataFrame | None:
    known = segments(spark, path)
    folders = [folder for _, _, folder in known.live]
    return kept.read(spark, path, name, landed_batches(spark, path, known.done), folders, condition)


def device_visits(spark: SparkSession, path: str, device_id: str) -> DataFrame:
    """All visits of one hashed device, from the partitions of the dates it was seen on.

    The dates come from the kept table ``device_dates``, of which one folder a segment and
    the matching row groups of landed batches are read; there are as many as dates at most.
    Where that table is not whole, every date is looked through.
    """
    wanted = F.col("device_id") == F.lit(device_id)
    visits = read_visits(spark, path).filter(wanted)
    bucket = F.col("bucket") == kept.bucket_of(F.lit(device_id))
    dates = _kept(spark, path, "device_dates", bucket & wanted)
    if dates is None:
        return visits
    found = [r["visit_date"] for r in dates.select("visit_date").collect()]
    seen = F.col("visit_date").isin([d for d in found if d is not None])
    return visits.filter(seen | F.col("visit_date").isNull() if None in found else seen)


def stored_counts(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Pings per (cell, hour, date) of a range of dates from the kept table ``cell_counts``,
    without a look at visits; ``hotspots.with_flags`` makes the report of them."""
    first, last = (F.lit(d).cast("date") for d in (start, end))
    bounds = [c for d, c in ((start, F.col("date") >= first), (end, F.col("date") <= last)) if d]
    condition = reduce(lambda a, b: a & b, bounds) if bounds else None
    counts = _kept(spark, path, "cell_counts", condition)
    if counts is None:
        raise ValueError(f"the counts of {path} are not kept for all batches")
    return counts.select("cell", "hour", "date", "pings")


def _landed(spark: SparkSession, path: str, fmt: str, done: int | None) -> DataFrame:
    landed = spark.read.format(fmt).schema(STORED_VISIT_SCHEMA).load(path)
    return landed if done is None else landed.filter(F.col("batch_id") > done)


def _published(spark: SparkSession, path: str, folder: str) -> DataFrame:
    stored = spark.read.schema(STORED_VISIT_SCHEMA).parquet(os.path.join(path, SEGMENTS, folder))
    return stored.select(*STORED_VISIT_SCHEMA.names)


def read_visits(
    spark: SparkSession,
    path: str | None = None,
    columns: list[str] | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Scan the visit table with its declared schema; published batches count once.

    Without a ``path`` the rows come through the connector ``fmt`` and its ``options``, as
    ``append`` wrote them; columns it does not have are NULL.
    """
    if path is None:
        loaded = spark.read.format(fmt).options(**(options or {})).load()
        table = loaded.select(
            *[
                (F.col(f.name) if f.name in loaded.columns else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in STORED_VISIT_SCHEMA
            ]
        )
    else:
        known = segments(spark, path)
        table = _landed(spark, path, fmt, known.done)
        for _, _, folder in known.live:
            table = table.unionByName(_published(spark, path, folder))
    return table.select(*columns) if columns else table


def register_view(visits: DataFrame, name: str = VIEW_NAME) -> None:
    """Expose visits to ``spark.sql`` under the name the readers use."""
    visits.createOrReplaceTempView(name)
