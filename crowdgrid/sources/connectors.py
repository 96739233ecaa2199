"""Micro-batches through any connector, each visit once, also after replays.

A connector appends; it knows neither batches nor commits. So a batch is first staged as
files, whose rows then stand for it in every try, and a log holds which batches have begun
and which are done. A batch that had begun and is not done may have been appended in part or
in whole: what the connector holds of it is read back, and only the staged rows that are not
there are appended, each as often as it is missing.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdgrid.schema import STORED_VISIT_SCHEMA
from crowdgrid.sources import files
from crowdgrid.sources.tables import append, read_visits, with_visit_date

# What reading says where nothing has been stored yet.
_NOTHING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


@dataclass
class ConnectorSink:
    """Writes batches of visits through ``fmt``, with its staging and log below ``log``.

    The connector must read with the options it writes with. One writer at a time, as a
    stream is; a new checkpoint numbers its batches anew and needs a new log and table.
    """

    fmt: str
    log: str
    options: dict[str, str] = field(default_factory=dict)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if files.exists(spark, self._mark("done", batch_id)):
            return
        staged = self.stage(batch, batch_id)
        rows = staged if self.begin(spark, batch_id) else self.missing(staged, batch_id)
        append(rows, None, self.fmt, self.options)
        files.create_new(spark, self._mark("done", batch_id))
        files.delete(spark, self._mark("staged", batch_id))

    def stage(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of the batch as they were first staged."""
        spark, path = batch.sparkSession, self._mark("staged", batch_id)
        if not files.exists(spark, os.path.join(path, "_SUCCESS")):
            owned = with_visit_date(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            owned.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def begin(self, spark: SparkSession, batch_id: int) -> bool:
        """Note that the batch is about to be appended; whether this is the first time."""
        return files.create_new(spark, self._mark("begun", batch_id))

    def missing(self, staged: DataFrame, batch_id: int) -> DataFrame:
        """The staged rows that the connector does not hold."""
        spark = staged.sparkSession
        try:
            stored = read_visits(spark, None, None, self.fmt, self.options)
        except AnalysisException as nothing:
            if nothing.getCondition() not in _NOTHING:
                raise
            return staged
        kinds = {f.name: f.dataType for f in STORED_VISIT_SCHEMA}
        mine = stored.filter(F.col("batch_id") == batch_id)
        return staged.exceptAll(
            mine.select(*[F.col(c).cast(kinds.get(c, t)).alias(c) for c, t in _kinds(staged)])
        )

    def _mark(self, kind: str, batch_id: int) -> str:
        return os.path.join(self.log, kind, str(batch_id))


def _kinds(df: DataFrame) -> list[tuple]:
    return [(f.name, f.dataType) for f in df.schema]
