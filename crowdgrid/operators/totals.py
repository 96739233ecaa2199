"""Small summaries over visits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdgrid.operators.hotspots import timed


def hourly_pings(visits: DataFrame) -> DataFrame:
    """Pings per (date, hour)."""
    return timed(visits).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("pings"))


def hourly_from_counts(counts: DataFrame) -> DataFrame:
    """The same table from cell counts, without reading the visits again."""
    return counts.groupBy("date", "hour").agg(F.sum("pings").alias("pings"))


def cluster_distribution(visits: DataFrame, per_batch: bool = False) -> DataFrame:
    """Visits per cluster, largest first; unclustered visits are left out.

    Cluster numbers of different micro-batches are unrelated, so ``per_batch``
    keeps them apart.
    """
    keys = ["batch_id", "cluster_pred"] if per_batch else ["cluster_pred"]
    return (
        visits.filter(F.col("cluster_pred").isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), *keys)
    )


def cluster_count(visits: DataFrame, per_batch: bool = False) -> DataFrame:
    """Number of distinct clusters."""
    distinct = F.countDistinct("cluster_pred").alias("clusters")
    return visits.groupBy("batch_id").agg(distinct) if per_batch else visits.agg(distinct)


def total_visits(visits: DataFrame) -> DataFrame:
    return visits.agg(F.count(F.lit(1)).alias("total"))


def mean_position(visits: DataFrame) -> DataFrame:
    return visits.agg(
        F.avg("lat_visit").alias("mean_lat"), F.avg("lon_visit").alias("mean_lon")
    )


def overview(visits: DataFrame) -> DataFrame:
    """Total, distinct clusters and mean position in one pass."""
    return visits.agg(
        F.count(F.lit(1)).alias("total"),
        F.countDistinct("cluster_pred").alias("clusters"),
        F.avg("lat_visit").alias("mean_lat"),
        F.avg("lon_visit").alias("mean_lon"),
    )
