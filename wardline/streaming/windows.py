"""Alerts and latencies of a running stream, closed window by window.

Rows are grouped in windows of a minute; the watermark trails the newest time seen by a
stated delay, a window that lies before it is closed, written once and forgotten, so
state is bounded by the alerts of that delay.  Rows that come later still are dropped
and counted.  What the closed windows do not hold yet is in the store; ``still_open``
tells which part of it that is.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from wardline.functions.expressions import event_instant
from wardline.operators.monitoring import ALERT_KEYS, alert_keyed
from wardline.operators.rollups import SKETCH, summed
from wardline.schema import ALERT_PARTS_SCHEMA

#: How long windows wait for late rows.
DELAY = "10 minutes"

#: Closed windows are parts without a batch.
CLOSED_SCHEMA = StructType([f for f in ALERT_PARTS_SCHEMA.fields if f.name not in ("batch_id", "batch_time")])
LATENCY_SCHEMA = StructType([
    StructField("batch_time", ALERT_PARTS_SCHEMA["batch_time"].dataType),
    *(f for f in ALERT_PARTS_SCHEMA.fields if f.name.startswith("latency_")),
])


def closing_alerts(det: DataFrame, delay: str = DELAY) -> DataFrame:
    """Alerts of a stream of stored rows as parts, by minute of the event."""
    keys = [k for k in ALERT_KEYS if k != "window_start_ts"]
    timed = det.withColumn("event_ts", event_instant()).withWatermark("event_ts", delay)
    rows = alert_keyed(timed, "event_ts")
    grouped = rows.groupBy(F.window("event_ts", "1 minute").alias("window"), *keys).agg(*summed())
    return grouped.select(F.col("window.start").alias("window_start_ts"), *CLOSED_SCHEMA.fieldNames()[1:])


def closing_latency(det: DataFrame, delay: str = DELAY) -> DataFrame:
    """Latencies of a stream as one sketch per minute of processing."""
    rows = det.select("processed_at", "latency_seconds").withWatermark("processed_at", delay)
    own = [
        F.sum("latency_seconds").alias("latency_sum"), F.count("latency_seconds").alias("latency_n"),
        F.max("latency_seconds").alias("latency_max"),
        F.kll_sketch_agg_double("latency_seconds", SKETCH).alias("latency_sketch"),
    ]
    grouped = rows.groupBy(F.window("processed_at", "1 minute").alias("window")).agg(*own)
    return grouped.select(F.col("window.start").alias("batch_time"), *LATENCY_SCHEMA.fieldNames()[1:])


def start_closing(windows: DataFrame, folder: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Write windows as they close; ``trigger=None`` takes what is there and stops.

    Each batch has a folder of its own and replaces it when it is run again, so a
    restart neither loses nor doubles a window.
    """
    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    writer = windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(keep)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


def closed_windows(windows: DataFrame, folder: str) -> DataFrame:
    """All windows written so far, with the columns of the stream that writes them."""
    return windows.sparkSession.read.schema(windows.schema).parquet(folder)


def horizon(query: StreamingQuery) -> datetime:
    """The watermark of a query's last batch: windows that end before or at it are closed."""
    text = ((query.lastProgress or {}).get("eventTime") or {}).get("watermark", "1970-01-01T00:00:00.000Z")
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)


def dropped(query: StreamingQuery) -> int:
    """Rows among the last reports that came after their window was closed."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def still_open(start: Column, until: datetime) -> Column:
    """Windows, by their start, that a stream with this horizon has not closed."""
    return start + F.expr("INTERVAL 1 MINUTE") > F.lit(until)
