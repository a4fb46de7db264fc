"""Streams of raw messages: every builder yields a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

#: Most records one micro-batch may take (a fixed value).
DEFAULT_MAX_RECORDS = 50_000

MESSAGE_SCHEMA = StructType([StructField("value", StringType(), True)])


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    max_records: int = DEFAULT_MAX_RECORDS,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options for one topic.

    ``starting`` counts only until a checkpoint exists.  ``max_records`` bounds
    a catch-up batch, and ``min_partitions`` splits a topic with few partitions
    so that decoding uses the whole cluster.
    """
    if starting not in ("latest", "earliest"):
        raise ValueError(f"start position must be latest or earliest, not {starting!r}")
    if max_records < 1:
        raise ValueError("a micro-batch must be allowed at least one record")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_records),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Topic as a stream; needs the Kafka connector on the session's class path."""
    options = kafka_options(servers, topic, **settings)
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession,
    path: str,
    file_format: str = "text",
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Message files as a stream, bounded per micro-batch by files or bytes."""
    reader = spark.readStream.format(file_format).schema(MESSAGE_SCHEMA)
    if max_files and max_bytes:
        raise ValueError("bound a micro-batch by files or by bytes, not both")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)
