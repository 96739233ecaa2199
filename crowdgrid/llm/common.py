"""Helpers shared by the text operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
# ``bytes.split()`` of Python splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"
WORD_PATTERN = re.compile(WORD)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not use, whatever columns it brings along."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"{base}_"
    return base


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text as an array, in SQL functions; NULL counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAPS), lambda w: w != F.lit(""))


def in_slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of bounded bytes of one column, at least one row each."""
    for batch in batches:
        start = held = 0
        for row, size in enumerate(_sizes(batch.column(column))):
            if row > start and held + size > most_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def _sizes(values: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_pylist()
