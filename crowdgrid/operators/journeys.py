"""Per-device journeys: ordered visits, start points, segments and paths.

A journey is ordered by (date_visit, lat_visit, lon_visit); visits without a time
come first. Identical visits share one point that carries how many there were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crowdgrid.session import materialise, scratch
from crowdgrid.sources.tables import VIEW_NAME

ORDER = ["date_visit", "lat_visit", "lon_visit"]
POINT = ["device_id", *ORDER]

# A device above this many visits is ordered by many tasks instead of one.
BUSY_VISITS = 5_000_000
# The list of busy devices is sent to the tasks up to this length, and joined beyond it.
MAX_BROADCAST = 200_000
# Visits per block of a busy device.
BLOCK_VISITS = 4_000_000


def device_visits(visits: DataFrame, device_id: str) -> DataFrame:
    """All visits of one hashed device; the equality reaches the scan."""
    return visits.filter(F.col("device_id") == F.lit(device_id))


def journey(visits: DataFrame, device_id: str) -> DataFrame:
    """The visits of one device in time order.

    The row number spreads any run of identical visits over the tasks of the sort. It
    comes after every column, so that only whole copies are told apart by it.
    """
    numbered = device_visits(visits, device_id).withColumn("_row", F.monotonically_increasing_id())
    others = [c for c in visits.columns if c not in POINT]
    return numbered.orderBy(*ORDER, *others, "_row").drop("_row")


def journey_sql(spark: SparkSession, device_id: str, view: str = VIEW_NAME) -> DataFrame:
    """The same through SQL with a bound parameter."""
    return spark.sql(
        "SELECT device_id, lat_visit, lon_visit, date_visit, cluster_pred FROM ("
        "  SELECT *, monotonically_increasing_id() AS row FROM IDENTIFIER(:view)"
        "  WHERE device_id = :device_id) "
        "ORDER BY date_visit, lat_visit, lon_visit, cluster_pred, row",
        args={"device_id": device_id, "view": view},
    )


def first_visits(visits: DataFrame) -> DataFrame:
    """Where each device starts; combined before the shuffle, one row per device and task."""
    start = F.min(F.struct(*ORDER)).alias("start")
    return (
        visits.filter(F.col("device_id").isNotNull())
        .groupBy("device_id")
        .agg(start)
        .select("device_id", *[F.col(f"start.{c}").alias(c) for c in ORDER])
    )


def ordered_points(
    visits: DataFrame,
    busy_visits: int = BUSY_VISITS,
    block_visits: int = BLOCK_VISITS,
) -> DataFrame:
    """Every distinct point of every device with its position and the point after it.

    Columns: device_id, date_visit, lat_visit, lon_visit, pings, pos, and ``after``,
    a struct of the next point that is NULL on the last one.

    Most devices fit one task: their visits move once, by device. A device with
    more than ``busy_visits`` visits is cut into blocks by range instead. The input is
    read twice: to count the visits of each device, and to order them.
    """
    known = visits.filter(F.col("device_id").isNotNull()).select(*POINT)
    busy = _busy_slots(known, busy_visits)
    total, several = busy.agg(F.sum("visits"), F.count(F.lit(1))).first()
    if not several:
        return _points_by_device(known)
    routed = _routed(known, F.broadcast(busy) if several <= MAX_BROADCAST else busy)
    blocks = -(-total // block_visits)
    quiet = _points_by_device(routed.filter("NOT busy").drop("busy"))
    return quiet.unionByName(_points_by_block(routed.filter("busy").drop("busy"), blocks))


def _busy_slots(visits: DataFrame, limit: int) -> DataFrame:
    """Hashes of devices with more visits than one task should hold.

    Tasks combine on a key of eight bytes. Devices of one hash are busy together, which
    changes nothing but the way they are ordered. At most ``total / limit`` hashes remain.
    """
    counted = visits.groupBy(F.xxhash64("device_id").alias("slot"))
    counted = counted.agg(F.count(F.lit(1)).alias("visits"))
    return materialise(counted.filter(F.col("visits") > limit))


def _routed(visits: DataFrame, busy: DataFrame) -> DataFrame:
    """The visits with ``busy``, stored apart by it, so that the input is read once for both."""
    path = scratch(visits.sparkSession, "routed")
    marks = busy.select(F.col("slot").alias("_slot"), F.lit(True).alias("busy"))
    marked = visits.join(marks, F.xxhash64("device_id") == F.col("_slot"), "left").drop("_slot")
    marked = marked.withColumn("busy", F.coalesce("busy", F.lit(False)))
    marked.write.partitionBy("busy").parquet(path)
    return visits.sparkSession.read.schema(marked.schema).parquet(path)


def _points_by_device(visits: DataFrame) -> DataFrame:
    """One shuffle and one sort by device; copies are found next to each other.

    A point starts where a row differs from the row before it. The distance to the
    start of the next point is the number of its copies.
    """
    device = Window.partitionBy("device_id")
    order = device.orderBy(*ORDER)
    here = F.struct(*ORDER)
    starts = visits.withColumns(
        {
            "_before": F.lag(here).over(order),
            "_row": F.row_number().over(order),
            "_rows": F.count(F.lit(1)).over(device),
        }
    ).filter(~F.col("_before").eqNullSafe(here))
    placed = starts.withColumns(
        {
            "pos": F.row_number().over(order).cast("bigint"),
            "after": F.lead(here).over(order),
            "_next": F.lead("_row").over(order),
        }
    )
    pings = F.coalesce("_next", F.col("_rows") + 1) - F.col("_row")
    return placed.select(*POINT, pings.alias("pings"), "pos", "after")


def _points_by_block(visits: DataFrame, blocks: int) -> DataFrame:
    """Range blocks of about equal size, then position and next point across them.

    The range bounds come from sampling, so the block of each point is written
    once and read back before anything depends on it. The table of block heads has
    one row per device and block.
    """
    points = visits.groupBy(*POINT).agg(F.count(F.lit(1)).alias("pings"))
    ranged = points.repartitionByRange(blocks, *POINT)
    ranged = materialise(ranged.withColumn("block", F.spark_partition_id()))

    by_block = Window.partitionBy("device_id").orderBy("block")
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        ranged.groupBy("device_id", "block")
        .agg(F.min(F.struct(*ORDER)).alias("head"), F.count(F.lit(1)).alias("size"))
        .withColumns(
            {
                "next_head": F.lead("head").over(by_block),
                "offset": F.coalesce(F.sum("size").over(before), F.lit(0)),
            }
        )
        .select("device_id", "block", "next_head", "offset")
    )
    within = Window.partitionBy("device_id", "block").orderBy(*ORDER)
    placed = ranged.withColumns(
        {"rank": F.row_number().over(within), "inner": F.lead(F.struct(*ORDER)).over(within)}
    )
    return placed.join(heads, ["device_id", "block"]).select(
        *POINT,
        "pings",
        (F.col("rank") + F.col("offset")).alias("pos"),
        F.coalesce("inner", "next_head").alias("after"),
    )


def journey_segments(visits: DataFrame, **sizes: int) -> DataFrame:
    """One row per line of the drawn path: from a point to the next one of the device."""
    return (
        ordered_points(visits, **sizes)
        .filter(F.col("after").isNotNull())
        .select(
            "device_id",
            "pos",
            F.col("date_visit").alias("from_date"),
            F.col("lat_visit").alias("from_lat"),
            F.col("lon_visit").alias("from_lon"),
            F.col("pings").alias("from_pings"),
            F.col("after.date_visit").alias("to_date"),
            F.col("after.lat_visit").alias("to_lat"),
            F.col("after.lon_visit").alias("to_lon"),
        )
    )


def journey_paths(visits: DataFrame, points_per_row: int = 1000, **sizes: int) -> DataFrame:
    """The ordered coordinate list of each device, in rows of bounded length.

    ``part`` numbers the rows of a device from 0; most devices need one. Each point
    repeats in ``pings`` how many identical visits it stands for.
    """
    points = ordered_points(visits, **sizes)
    part = F.floor((F.col("pos") - 1) / F.lit(points_per_row)).alias("part")
    entry = F.struct("pos", "date_visit", "lat_visit", "lon_visit", "pings")
    path = F.array_sort(F.collect_list(entry))
    return points.groupBy("device_id", part).agg(
        F.transform(
            path,
            lambda p: F.struct(
                p["lat_visit"].alias("lat"), p["lon_visit"].alias("lon"), p["pings"].alias("pings")
            ),
        ).alias("path")
    )
