"""Running totals and look-backs over one long ordered series.

An ``OVER (ORDER BY batch_id)`` without partitions sends the whole series to
one task.  Here the series is cut into blocks of consecutive ids: each block is
scanned on its own and only one summary row per block is carried across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 4096


def _in_blocks(df: DataFrame, order_by: str, size: int) -> DataFrame:
    """Rows with their block; filtered here so that both uses share a shuffle."""
    block = F.floor(F.col(order_by) / F.lit(size))
    return df.withColumn("_block", block).where(F.col("_block").isNotNull())


def running_totals(
    df: DataFrame,
    order_by: str,
    totals: dict[str, str],
    block_size: int = DEFAULT_BLOCK,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add cumulative sums; ``totals`` maps an output name to an input column.

    ``order_by`` is an integer column with one row per value of each series; ``by`` names the series.
    """
    blocked = _in_blocks(df, order_by, block_size)
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.groupBy(*by, "_block")
        .agg(*[F.sum(source).alias(f"_sum_{name}") for name, source in totals.items()])
        .select(
            *by,
            "_block",
            *[
                F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_carry_{name}")
                for name in totals
            ],
        )
    )
    within = (
        Window.partitionBy(*by, "_block")
        .orderBy(order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inner = blocked.select(
        "*", *[F.sum(source).over(within).alias(f"_run_{name}") for name, source in totals.items()]
    )
    return inner.join(carried, [*by, "_block"]).select(
        *df.columns,
        *[(F.col(f"_run_{name}") + F.col(f"_carry_{name}")).alias(name) for name in totals],
    )


def previous_value(
    df: DataFrame,
    order_by: str,
    name: str = "previous",
    block_size: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Add the next smaller value of ``order_by``, null on the first row."""
    blocked = _in_blocks(df, order_by, block_size)
    carried = (
        blocked.groupBy("_block")
        .agg(F.max(order_by).alias("_last"))
        .select("_block", F.lag("_last").over(Window.orderBy("_block")).alias("_carry"))
    )
    within = Window.partitionBy("_block").orderBy(order_by)
    inner = blocked.withColumn("_lag", F.lag(order_by).over(within))
    return inner.join(carried, "_block").select(
        *df.columns, F.coalesce("_lag", "_carry").alias(name)
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row frames side by side without a join.

    Column names must differ between the frames.
    """
    columns: Sequence[str] = [name for frame in frames for name in frame.columns]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in columns])
