"""Exact quantiles whose tasks stay small however large or skewed the group is.

Spark's own ``percentile`` keeps one map of every distinct value of a group in
a single task.  Here the wanted ranks are found by zooming in:

1. rows collapse to (group, value) counts - ties, however many, become one row
   before the shuffle, and it hashes on the value too, so no group is hot;
2. the counts are summed per coarse bucket of values, a running sum over the
   buckets of a group tells which of them hold the wanted ranks, and the values
   of just those go on to the next, finer buckets;
3. after the last bucket width the remaining values are ranked one by one.

A window partition holds the coarse buckets of one group, the fine buckets of
one coarse bucket, or the distinct values of one fine bucket.  All three are
bounded by value range, width ratio and value resolution - not by rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: For seconds: 64 s, then 1/1024 s.  A year of latencies has half a million
#: coarse buckets, a coarse bucket 65,536 fine ones, and a fine one, at the
#: resolution of epoch seconds in a double, some 4,000 distinct values.
DEFAULT_WIDTHS = (64.0, 2.0**-10)

#: Coarse buckets on either side of zero (a year of seconds); whatever lies further out shares the outermost.
OUTERMOST = 2**19

_NAN_BUCKET = 2**63 - 1


def _bucket(width: float, outermost: int | None = None) -> Column:
    """Bucket number of a value, in value order; NaN comes last."""
    value = F.col("_value")
    if outermost:
        value = F.greatest(F.lit(-outermost * width), F.least(F.lit(outermost * width), value))
    return F.when(F.isnan("_value"), F.lit(_NAN_BUCKET)).otherwise(F.floor(value / F.lit(width)))


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    widths: Sequence[float] = DEFAULT_WIDTHS,
) -> DataFrame:
    """One row per group with linearly interpolated quantiles.

    ``quantiles`` maps output column names to probabilities; the group keys are
    kept.  Null values are ignored and NaN sorts last, as in ``percentile``.
    ``widths`` are the bucket widths, coarse to fine, and only affect speed.
    Groups start with the finest width; what is ungrouped has no more than
    ``2 * OUTERMOST`` coarse buckets, and the buckets that hold the wanted ranks
    are at most two per quantile, which is few enough to broadcast.
    """
    # one struct key: equal also where parts of it are null
    keys = ["_key"] if by else []
    tally = (
        df.select(*[F.struct(*by).alias(k) for k in keys], F.col(value).alias("_value"))
        .where(F.col("_value").isNotNull())
        .groupBy(*keys, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_size") - 1)

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_start")) & (rank < F.col("_end"))

    wanted = reduce(
        or_,
        [holds(edge(position(p))) for p in quantiles.values() for edge in (F.floor, F.ceil)],
    )

    def placed(pieces: DataFrame, inside: Sequence[str], order: str, known: bool) -> DataFrame:
        """Ranks [_start, _end) of each piece, counted on from its parent's."""
        parent = Window.partitionBy(*inside)
        so_far = parent.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = F.sum("_n").over(so_far)
        size = F.col("_size") if known else F.sum("_n").over(parent)
        base = F.col("_base") if known else F.lit(0)
        return pieces.select(
            *inside, order, size.alias("_size"),
            (base + upto - F.col("_n")).alias("_start"), (base + upto).alias("_end"),
        )

    inside, candidates = list(keys), tally
    for level, width in enumerate(widths[-1:] if by else widths):
        name, known = f"_bucket{level}", level > 0
        # The join below would add this filter to its own side only, and the
        # two uses of the counts could then no longer share one shuffle.
        candidates = candidates.withColumn(name, _bucket(width, None if known or by else OUTERMOST)).where(F.col(name).isNotNull())
        carried = [F.first(c).alias(c) for c in ("_size", "_base") if known]
        pieces = candidates.groupBy(*inside, name).agg(F.sum("_n").alias("_n"), *carried)
        chosen = placed(pieces, inside, name, known).where(wanted)
        inside = [*inside, name]
        chosen = chosen.select(*inside, "_size", F.col("_start").alias("_base"))
        candidates = candidates.select(*inside, "_value", "_n").join(chosen if by else F.broadcast(chosen), inside)
    ranked = placed(candidates, inside, "_value", known=True)

    picks = []
    for i, p in enumerate(quantiles.values()):
        for side, edge in (("low", F.floor), ("high", F.ceil)):
            picks.append(F.max(F.when(holds(edge(position(p))), F.col("_value"))).alias(f"_{side}{i}"))
    picked = ranked.groupBy(*keys).agg(F.max("_size").alias("_size"), *picks)

    results = []
    for i, (name, p) in enumerate(quantiles.items()):
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        weight = position(p) - F.floor(position(p))
        results.append(
            F.when(low == high, low).otherwise(low * (1 - weight) + high * weight).alias(name)
        )
    return picked.select(*[f"_key.{name}" for name in by], *results)
