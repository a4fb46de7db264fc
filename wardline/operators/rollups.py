"""Alerts and latencies in parts: what a batch or a stream adds, folded when somebody looks.

Counts, extremes and sums of parts add up to those of all rows; services are kept as
sets, whose union is exact; latencies as KLL sketches, which merge without losing more
than one sketch of all rows would.  Reading parts costs a row per batch and alert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.expressions import minute_of
from wardline.operators.monitoring import ALERT_KEYS, alert_keyed, alert_rows
from wardline.schema import DISPLAY_TIME_ZONE

#: Size of a sketch.  A quantile read from one, merged or not, is a value whose rank is
#: off by at most ``RANK_ERROR`` of all rows, with a confidence of 99%.
SKETCH, RANK_ERROR = 400, 0.01

LATENCY_QUANTILES = {"p50_s": 0.50, "p95_s": 0.95}


def summed() -> list[Column]:
    """Aggregates over keyed rows that make a part; plain ones, so a stream can keep them too."""
    return [
        F.count(F.lit(1)).alias("event_count"),
        F.array_sort(F.collect_set("service")).alias("services"),
        F.min("connections").alias("conn_min"),
        F.max("connections").alias("conn_max"),
        F.sum("latency_seconds").alias("latency_sum"),
        F.count("latency_seconds").alias("latency_n"),
        F.max("latency_seconds").alias("latency_max"),
        F.kll_sketch_agg_double("latency_seconds", SKETCH).alias("latency_sketch"),
    ]


def alert_parts(det: DataFrame) -> DataFrame:
    """What each batch adds to each alert."""
    keyed = alert_keyed(det, "batch_id", F.col("processed_at").alias("batch_time"))
    return keyed.groupBy("batch_id", "batch_time", *ALERT_KEYS).agg(*summed())


def alerts_of(parts: DataFrame, zone: str = DISPLAY_TIME_ZONE) -> DataFrame:
    """The alerts that parts add up to: what ``monitoring.alerts`` makes of all their rows."""
    grouped = parts.groupBy(*ALERT_KEYS).agg(
        F.sum("event_count").alias("event_count"),
        F.size(F.array_distinct(F.flatten(F.collect_set("services")))).cast("bigint").alias("services_touched"),
        F.min("conn_min").alias("conn_min"),
        F.max("conn_max").alias("conn_max"),
        F.round(F.try_divide(F.sum("latency_sum"), F.sum("latency_n")), 2).alias("avg_latency_s"),
    )
    return alert_rows(grouped, zone)


def latency_of(parts: DataFrame, clock: str = "batch_time") -> DataFrame:
    """Median, p95 and maximum latency per minute of processing; ranks are off by ``RANK_ERROR`` at most."""
    merged = parts.where("latency_n > 0").groupBy(minute_of(F.col(clock)).alias("minute")).agg(
        F.kll_merge_agg_double("latency_sketch", SKETCH).alias("sketch"), F.max("latency_max").alias("most")
    )
    return merged.select(
        "minute",
        *(F.round(F.kll_sketch_get_quantile_double("sketch", F.lit(p)), 2).alias(n) for n, p in LATENCY_QUANTILES.items()),
        F.round("most", 2).alias("max_s"),
    )
