"""Single files and folders of the shared storage, through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders whose names match; none if their parent is missing."""
    path, system = _place(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(path) or []]


def dated(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Matching files and folders with the time of their last change, epoch seconds."""
    path, system = _place(spark, pattern)
    found = system.globStatus(path) or []
    return [(status.getPath().toString(), status.getModificationTime() / 1000) for status in found]


def delete(spark: SparkSession, location: str) -> None:
    path, system = _place(spark, location)
    system.delete(path, True)


def create(spark: SparkSession, location: str, text: str) -> bool:
    """Write a small file unless it is there already; whether this call wrote it.

    The text goes to a name of its own first, so the file appears whole or not at all.
    """
    path, system = _place(spark, location)
    if system.exists(path):
        return False
    aside, _ = _place(spark, f"{location}.{spark._jvm.java.util.UUID.randomUUID()}")
    out = system.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    system.mkdirs(path.getParent())
    won = not system.exists(path) and system.rename(aside, path)
    if not won:
        system.delete(aside, False)
    return bool(won)


def read(spark: SparkSession, location: str) -> str | None:
    """The text of a small file, or nothing if there is none."""
    path, system = _place(spark, location)
    if not system.exists(path):
        return None
    source = system.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
