"""Shape evaluated rows for the two stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.functions.expressions import is_attack
from wardline.schema import (
    COUNT_LABEL_COLUMN,
    RECORD_SCHEMA,
    STATUS_COLUMN,
    VALID,
    VERDICT_FIELDS,
)


def _is_worth_storing(columns: Sequence[str]) -> Column:
    kept = is_attack() | F.col("is_detection")
    return kept & (F.col(STATUS_COLUMN) == VALID) if STATUS_COLUMN in columns else kept


def worth_storing(df: DataFrame) -> DataFrame:
    """Real attacks and flagged rows; quiet normal traffic is only counted."""
    return df.where(_is_worth_storing(df.columns))


def _counted_as(columns: Sequence[str]) -> str:
    return COUNT_LABEL_COLUMN if COUNT_LABEL_COLUMN in columns else "label"


def narrowed(df: DataFrame) -> DataFrame:
    """What the stored tables need of evaluated rows: the label each counts under, and ``kept``,
    the whole row if it is worth storing."""
    whole = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    return df.select(_counted_as(df.columns), F.when(_is_worth_storing(df.columns), whole).alias("kept"))


def kept_rows(narrow: DataFrame) -> DataFrame:
    """The rows that ``narrowed`` has kept."""
    return narrow.where("kept IS NOT NULL").select("kept.*")


def latency_seconds(processed_at: Column, epoch_seconds: str = "timestamp") -> Column:
    return F.unix_micros(processed_at) / F.lit(1e6) - F.col(epoch_seconds)


def detections(
    df: DataFrame,
    batch_id: Column,
    processed_at: Column,
    schema: StructType = RECORD_SCHEMA,
) -> DataFrame:
    """Rows of the detections table.

    ``batch_id`` and ``processed_at`` are literals for one micro-batch, or
    columns when many batches are prepared in a single job.
    """
    return worth_storing(df).select(
        *[f"`{name}`" for name in schema.fieldNames()],
        *VERDICT_FIELDS,
        batch_id.cast("bigint").alias("batch_id"),
        processed_at.alias("processed_at"),
        latency_seconds(processed_at).alias("latency_seconds"),
    )


def sort_for_storage(df: DataFrame) -> DataFrame:
    """Cluster by label and order within files, so row groups can be skipped.

    The rebalance hint lets adaptive execution choose the number of files and
    cut a label that holds most rows into several of them.
    """
    return df.hint("rebalance", "label").sortWithinPartitions("label", "timestamp")


def traffic_counts(df: DataFrame, batch_id: Column, batch_time: Column) -> DataFrame:
    """One row per batch and label, malformed rows under their reserved label."""
    return (
        df.groupBy(
            batch_id.cast("bigint").alias("batch_id"),
            batch_time.alias("batch_time"),
            F.col(_counted_as(df.columns)).alias("label"),
        )
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
