"""JSON messages: reading, decoding, encoding and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdgrid.schema import message_schema


def kafka_options(bootstrap_servers: str, topic: str, **extra: str) -> dict[str, str]:
    """One topic, from the earliest offset, tolerating expired offsets, without encryption.

    ``extra`` overrides or adds connector options, e.g. ``maxOffsetsPerTrigger``.
    """
    # The connector settings of the job.
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.security.protocol": "PLAINTEXT",
        **extra,
    }


def read_messages(
    spark: SparkSession,
    source: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """A table or stream with a ``value`` column, from Kafka or from line-delimited files."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(source).options(**(options or {}))
    return reader.load(path) if path else reader.load()


def decode(messages: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Decode ``value`` into text columns; malformed messages become all-NULL rows.

    The generator keeps each message parsed once: a filter on decoded columns
    would otherwise be pushed below the projection together with a second parse.
    Name the ``fields`` wanted, and the parser skips the others.
    """
    parsed = F.from_json(F.col("value").cast("string"), message_schema(fields))
    return messages.select(F.inline(F.array(parsed)))


def encode(rows: DataFrame) -> DataFrame:
    """Each row as one JSON object in a ``value`` column."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def publish(rows: DataFrame, sink: str = "kafka", path: str | None = None, **options: str) -> None:
    """Encode rows and write them to a topic or to text files, from the executors."""
    writer = encode(rows).write.format(sink).options(**options).mode("append")
    writer.save(path) if path else writer.save()
