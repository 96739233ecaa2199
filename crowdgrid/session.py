"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def builder(app_name: str = "crowdgrid") -> SparkSession.Builder:
    """Cluster-neutral defaults; master, memory and shuffle width are left to the deployment."""
    b = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def pin(spark: SparkSession) -> SparkSession:
    """Set the one setting that changes results on a session someone else built."""
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A machine-local folder is made only for a ``local`` master that names none.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="crowdgrid-")
        sc.setCheckpointDir(named)
    return named


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python a few MB at a time: a batch is held by the executor and by its
    Python workers, several times over. A limit that someone has set stands."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "4m")


_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _made.append(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Remove what this driver wrote under ``scratch``, once its results are no longer read."""
    removed = 0
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        removed += files.delete(path, True)
    return removed


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, so that lost executors lose nothing."""
    path = scratch(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
