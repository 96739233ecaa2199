"""Small tables kept beside the visit table, batch by batch, and read in its place.

Each is derived from the visits of a batch, overwritten when the batch is written again, and
merged when batches are compacted, from the kept tables alone. What is read are the tables of
the live segments and of the batches landed after them, merged once more, so the order of the
batches and their replays do not matter. A kept table is used only where all parts of the
visit table have it.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdgrid.operators.hotspots import cell_counts
from crowdgrid.sources import files

FOLDER = "_kept"
LANDED = "landed"
# Folders that the devices of a segment are dealt to.
BUCKETS = 64

BLOOM = {
    "parquet.bloom.filter.enabled#device_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


@dataclass(frozen=True)
class Kept:
    """How a kept table comes from visits, how parts merge, and how a segment is laid out."""

    schema: str
    derive: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    partition: str
    order: str


def bucket_of(device_id: Column) -> Column:
    """The folder of a device; devices without an id share one."""
    return F.pmod(F.xxhash64(device_id), F.lit(BUCKETS)).cast("int")


def _dates(visits: DataFrame) -> DataFrame:
    seen = visits.select("device_id", "visit_date").distinct()
    return seen.withColumn("bucket", bucket_of(F.col("device_id")))


def _counts(visits: DataFrame) -> DataFrame:
    return cell_counts(visits).select("cell", "hour", "pings", "date")


def _added(counts: DataFrame) -> DataFrame:
    added = counts.groupBy("cell", "hour", "date").agg(F.sum("pings").alias("pings"))
    return added.select("cell", "hour", "pings", "date")


KEPT: dict[str, Kept] = {
    # The dates on which each device was seen.
    "device_dates": Kept(
        "device_id string, visit_date date, bucket int", _dates, DataFrame.distinct, "bucket", "device_id"
    ),
    # Pings per cell, hour and date, from which every report starts.
    "cell_counts": Kept("cell bigint, hour int, pings bigint, date date", _counts, _added, "date", "cell"),
}


def _folder(path: str, name: str, *more: str) -> str:
    return os.path.join(path, FOLDER, name, *more)


def write_landed(visits: DataFrame, batch_id: int, path: str, names: tuple[str, ...]) -> None:
    """Keep the tables of one batch, in place of what an earlier try left."""
    for name in names:
        kept = KEPT[name]
        target = _folder(path, name, LANDED, str(batch_id))
        found = kept.derive(visits).hint("rebalance").sortWithinPartitions(kept.order)
        found.write.options(**BLOOM).mode("overwrite").parquet(target)


def write_segment(
    spark: SparkSession, path: str, folder: str, batches: list[int], merged: list[str]
) -> None:
    """Merge the kept tables of landed batches and of segments for a new segment. A table
    that one of them lacks is not kept for the segment."""
    for name, kept in KEPT.items():
        parts = _parts(spark, path, name, batches, merged)
        if parts is None:
            continue
        rows = reduce(DataFrame.unionByName, [spark.read.schema(kept.schema).parquet(p) for p in parts])
        laid = kept.merge(rows).hint("rebalance", kept.partition)
        writer = laid.sortWithinPartitions(kept.partition, kept.order).write.options(**BLOOM)
        target = _folder(path, name, folder)
        writer.mode("overwrite").partitionBy(kept.partition).parquet(target)


def _parts(
    spark: SparkSession, path: str, name: str, batches: list[int], folders: list[str]
) -> list[str] | None:
    """The folders of a kept table; None where one is missing or there is none."""
    wanted = [_folder(path, name, LANDED, str(b)) for b in batches]
    wanted += [_folder(path, name, f) for f in folders]
    whole = all(files.exists(spark, os.path.join(w, "_SUCCESS")) for w in wanted)
    return wanted if wanted and whole else None


def read(
    spark: SparkSession,
    path: str,
    name: str,
    batches: list[int],
    folders: list[str],
    condition: Column | None = None,
) -> DataFrame | None:
    """The rows of a kept table that meet a condition, merged; None where it is not whole."""
    kept, parts = KEPT[name], _parts(spark, path, name, batches, folders)
    if parts is None:
        return None
    names = [field.split()[0] for field in kept.schema.split(", ")]
    rows = [spark.read.schema(kept.schema).parquet(p).select(*names) for p in parts]
    if condition is not None:
        rows = [r.filter(condition) for r in rows]
    return kept.merge(reduce(DataFrame.unionByName, rows))


def tidy(spark: SparkSession, path: str, done: int, gone: list[str]) -> int:
    """Remove the kept tables of published batches and of segments that are gone."""
    removed = 0
    for name in KEPT:
        landed = files.matching(spark, _folder(path, name, LANDED, "*"))
        old = [f for f in landed if int(os.path.basename(f)) <= done]
        old += [_folder(path, name, folder) for folder in gone]
        removed += sum(files.delete(spark, f) for f in old if files.exists(spark, f))
    return removed
