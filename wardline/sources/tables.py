"""Reading the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A Parquet table of the data folder; a file or a folder of part files."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def _file_system(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def state_of(spark: SparkSession, directory: str, name: str) -> tuple[int, int, int]:
    """Bytes, files and modification time of a table, to notice a rewrite."""
    path, files = _file_system(spark, f"{directory.rstrip('/')}/{name}.parquet")
    summary = files.getContentSummary(path)
    return summary.getLength(), summary.getFileCount(), files.getFileStatus(path).getModificationTime()


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a finished write left its mark in the folder."""
    path, files = _file_system(spark, f"{folder}/_SUCCESS")
    return files.exists(path)
