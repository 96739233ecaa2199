"""Small files on the driver, in any file system that Spark reaches."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.delete(place, True)


def matching(spark: SparkSession, pattern: str) -> dict[str, int]:
    """The paths that a pattern finds, with the milliseconds of their last change."""
    files, place = _place(spark, pattern)
    found = files.globStatus(place) or []
    return {status.getPath().toString(): status.getModificationTime() for status in found}


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str = "") -> bool:
    """Write a file unless it is there; whether this call wrote it.

    Of several callers at once one succeeds: a local file is linked into place whole, other
    file systems create a file without overwriting in one step (object stores need a
    connector that does).
    """
    files, place = _place(spark, path)
    files.mkdirs(place.getParent())
    if files.getUri().getScheme() == "file":
        target = place.toUri().getPath()
        draft = os.path.join(os.path.dirname(target), f".{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        stream = files.create(place, False)
    except Py4JJavaError:
        if files.exists(place):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True
