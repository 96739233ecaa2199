"""The clustering stream: messages in, clustered visits out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdgrid.operators.clusters import PositionModel, assign, cluster, fit_best, is_empty
from crowdgrid.schema import CLUSTERED_COLUMNS
from crowdgrid.sources.connectors import ConnectorSink
from crowdgrid.sources.tables import append, write_batch

# Fixed value: the trigger interval of the job.
TRIGGER = "10 seconds"


@dataclass
class StoreBatch:
    """Callback that writes one micro-batch to the visit table under its ``batch_id``.

    With ``connector`` the rows are appended through that format instead of to files, and
    ``log`` names the folder of its staging and commit log, which keep a replay from storing
    a visit twice. Without a ``log``, for connectors that cannot read back, it may. ``keep``
    names the tables that are kept beside files.
    """

    path: str | None = None
    connector: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    log: str | None = None
    keep: tuple[str, ...] = ()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.connector and self.log:
            ConnectorSink(self.connector, self.log, self.options).write(batch, batch_id)
        elif self.connector:
            numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            append(numbered, None, self.connector, self.options)
        else:
            write_batch(batch, batch_id, self.path, keep=self.keep)


@dataclass
class ClusterBatch(StoreBatch):
    """The same after clustering the batch.

    The batch is persisted, so its messages are read and parsed once. Each batch
    has its own cluster numbers.
    """

    choice: dict = field(default_factory=dict)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not is_empty(held):
                super().__call__(cluster(held, **self.choice).select(*CLUSTERED_COLUMNS), batch_id)
        finally:
            held.unpersist()


def run_batches(
    visits: DataFrame,
    callback: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = False,
    interval: str = TRIGGER,
) -> StreamingQuery:
    """Start the stream; ``once`` works through what is there now and stops."""
    writer = visits.writeStream.foreachBatch(callback).option("checkpointLocation", checkpoint)
    timing = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**timing).start()


def save_model(history: DataFrame, path: str, **choice) -> PositionModel | None:
    """Fit once on stored visits and save, so that labels keep their meaning."""
    model = fit_best(history, **choice)
    if model is not None:
        model.save(path)
    return model


def score_stream(visits: DataFrame, model_path: str) -> DataFrame:
    """Label a stream or table of visits with a saved model; row-wise, no state."""
    return assign(PositionModel.load(model_path), visits).select(*CLUSTERED_COLUMNS)
