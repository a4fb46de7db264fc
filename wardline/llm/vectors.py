"""Vectors in packed shards, and queries in packed blocks that visit every shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.exchange import stored

#: Vectors in a shard, and queries in a block.
SHARD, QUERIES = 4096, 512


def finite(embedding: str = "embedding") -> Column:
    """Neither null nor holding a null or a component that is not finite."""
    whole = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(embedding).isNotNull() & F.coalesce(F.forall(embedding, whole), F.lit(False))


def usable(vectors: DataFrame) -> DataFrame:
    """``key, vec_id, embedding`` (doubles) of the vectors that take part.

    Rows without an id take none.  Every other row is one of its own, also where ids
    repeat: ``key`` tells them apart once the result has been written, and keys ascend
    as ids do.  Rows of one id may be dealt to several ranges.
    """
    rows = vectors.where(finite() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.monotonically_increasing_id().alias("turn"),
    )
    ordered = rows.repartitionByRange("vec_id", "turn").sortWithinPartitions("vec_id", "turn")
    return ordered.select(F.monotonically_increasing_id().alias("key"), "vec_id", "embedding")


def matrix(lists: pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    """Rows of a list column as a matrix, shorter rows filled up with zeros."""
    lists = lists.combine_chunks()
    out = np.zeros((len(lists), width), dtype=kind)
    lengths = np.diff(lists.offsets.to_numpy())
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def dealt(vectors: DataFrame, size: int, rows: int, seed: int) -> DataFrame:
    """``vectors`` with a number ``shard`` that deals about ``size`` rows to each."""
    return vectors.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(max(1, -(-rows // size)))).cast("int"))


def to_every_shard(queries: DataFrame, shards: int) -> DataFrame:
    """Blocks of queries, once for every shard: few bytes beside those of the shards."""
    return queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))


def best_of(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores of each query row with their rank, ties to the smaller id.

    ``rows`` has ``query, query_id, key, vec_id, score``; ``query`` and ``key`` name rows.
    """
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "key")
    return (
        rows.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


__all__ = ["QUERIES", "SHARD", "best_of", "dealt", "finite", "matrix", "stored", "to_every_shard", "usable"]
