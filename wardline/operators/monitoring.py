"""What an operator watches: alerts, rates, time series and batch health."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.expressions import (
    CLOCK_FORMAT,
    MINUTE_FORMAT,
    SECOND_FORMAT,
    count_where,
    display_time,
    event_instant,
    failure_kind,
    has_reserved_prefix,
    is_attack,
    is_normal,
    listed,
    minute_of,
    problem_rank,
    ratio,
    total,
    verdict,
)
from wardline.functions.quantiles import exact_quantiles
from wardline.functions.running import one_row, previous_value, running_totals
from wardline.operators.scoring import attribution, batch_key
from wardline.schema import DISPLAY_TIME_ZONE, INCOMPLETE, UNPARSEABLE


# --- key figures ------------------------------------------------------------

def _outcomes(det: DataFrame) -> DataFrame:
    return det.agg(
        count_where(is_attack() & F.col("is_detection")).alias("true_positives"),
        count_where(is_attack() & ~F.col("is_detection")).alias("missed"),
        count_where(is_normal() & F.col("is_detection")).alias("false_positives"),
    )


def volume_kpis(det: DataFrame, counts: DataFrame) -> DataFrame:
    traffic = counts.where(~has_reserved_prefix()).agg(
        total(F.when(is_attack(), F.col("record_count"))).alias("attack_records"),
        total(F.col("record_count")).alias("total_records"),
    )
    return one_row(traffic, _outcomes(det))


def accuracy_kpis(det: DataFrame, counts: DataFrame) -> DataFrame:
    normal = counts.where(is_normal()).agg(total(F.col("record_count")).alias("normal_total"))
    tp, fn, fp = F.col("true_positives"), F.col("missed"), F.col("false_positives")
    return one_row(_outcomes(det), normal).select(
        ratio(tp, tp + fn).alias("recall"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(fp, F.col("normal_total")).alias("false_positive_rate"),
    )


# --- alerts -----------------------------------------------------------------

def with_verdict(df: DataFrame) -> DataFrame:
    judged = df.withColumn("verdict", verdict())
    return judged.withColumn("problem_rank", problem_rank())


#: What makes records one alert.
ALERT_KEYS = ["window_start_ts", "verdict", "actual_label", "detected_as", "rules_fired", "max_severity"]


def alert_keyed(det: DataFrame, *keep: str | Column) -> DataFrame:
    """Stored rows with the keys of their alert and what alerts sum up."""
    return det.select(
        *keep,
        minute_of(event_instant()).alias("window_start_ts"),
        verdict().alias("verdict"),
        F.col("label").alias("actual_label"),
        listed("matched_attack_types").alias("detected_as"),
        listed("matched_rule_ids").alias("rules_fired"),
        "max_severity",
        "service",
        F.col("`count`").alias("connections"),
        "latency_seconds",
    )


def alert_rows(grouped: DataFrame, zone: str = DISPLAY_TIME_ZONE) -> DataFrame:
    """Alerts with display text and rank, which follow from the keys."""
    return grouped.select(
        display_time(F.col("window_start_ts"), MINUTE_FORMAT, zone).alias("window_start"),
        *ALERT_KEYS, "event_count", "services_touched", "conn_min", "conn_max", "avg_latency_s",
        problem_rank().alias("problem_rank"),
    )


def alerts(det: DataFrame, zone: str = DISPLAY_TIME_ZONE) -> DataFrame:
    """One row per minute, class, claim and verdict instead of one per record.

    Display text and the rank follow from the keys, so they are worked out per
    alert after the aggregation.
    """
    grouped = alert_keyed(det).groupBy(*ALERT_KEYS).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("service").alias("services_touched"),
        F.min("connections").alias("conn_min"),
        F.max("connections").alias("conn_max"),
        F.round(F.avg("latency_seconds"), 2).alias("avg_latency_s"),
    )
    return alert_rows(grouped, zone)


def top_alerts(alert_rows: DataFrame, limit: int = 100) -> DataFrame:
    """Newest first, problems first, largest first; the keys break the ties."""
    return alert_rows.orderBy(
        F.desc("window_start_ts"), "problem_rank", F.desc("event_count"),
        "actual_label", "detected_as", "rules_fired", "max_severity", "verdict",
    ).limit(limit)


def only_verdict(rows: DataFrame, wanted: str = "FALSE POSITIVE") -> DataFrame:
    return rows.where(F.col("verdict") == wanted)


def raw_rows(
    det: DataFrame, zone: str = DISPLAY_TIME_ZONE, row_key: Sequence[str] = ()
) -> DataFrame:
    """One display row per stored record, for looking into an alert."""
    judged = with_verdict(det)
    return judged.select(
        *row_key,
        display_time(event_instant(), SECOND_FORMAT, zone).alias("event_time"),
        display_time(minute_of(event_instant()), MINUTE_FORMAT, zone).alias("window_start"),
        minute_of(event_instant()).alias("window_start_ts"),
        event_instant().alias("event_ts"),
        F.col("label").alias("actual_label"),
        listed("matched_attack_types").alias("detected_as"),
        listed("matched_rule_ids").alias("rules_fired"),
        "max_severity", "verdict", "protocol_type", "service", "src_bytes", "dst_bytes",
        F.col("`count`").alias("connection_count"),
        F.round("latency_seconds", 3).alias("latency_s"),
        "problem_rank",
    )


def latest_raw_rows(rows: DataFrame, row_key: Sequence[str], limit: int = 500) -> DataFrame:
    """The newest rows; what is shown and ``row_key`` make the order total, up to equal rows."""
    shown = [c for c in rows.columns if c not in ("event_ts", "problem_rank", *row_key)]
    return rows.orderBy(F.desc("event_ts"), "problem_rank", *row_key, *shown).limit(limit)


def drill_down(rows: DataFrame, alert_rows: DataFrame) -> DataFrame:
    """Raw rows that fall into the minute of any of the given alerts."""
    windows = alert_rows.select("window_start_ts").distinct()
    return rows.join(windows, "window_start_ts", "left_semi").select(*rows.columns)


def recall_by_type(det: DataFrame) -> DataFrame:
    caught = count_where(F.col("is_detection"))
    return (
        det.where(is_attack())
        .groupBy(F.col("label").alias("attack_type"))
        .agg(
            F.count(F.lit(1)).alias("seen"),
            caught.alias("caught"),
            count_where(~F.col("is_detection")).alias("missed"),
        )
        .withColumn("recall_pct", F.round(100 * ratio(F.col("caught"), F.col("seen")), 1))
        .orderBy(F.desc("missed"), "attack_type")
    )


def precision_by_type(det: DataFrame) -> DataFrame:
    return (
        attribution(det, claims_name="times_claimed")
        .withColumn("precision_pct", F.round(100 * ratio(F.col("correct"), F.col("times_claimed")), 1))
        .orderBy("precision_pct", "attack_type")
    )


# --- time series ------------------------------------------------------------

def since(
    df: DataFrame, column: str, minutes: int | None, now: Column | datetime | None = None
) -> DataFrame:
    """Rows of the last ``minutes`` before ``now`` (the current time if unset).

    A plain comparison of the stored column, so it reaches the scan.
    """
    if minutes is None:
        return df
    instant = F.current_timestamp() if now is None else now
    instant = F.lit(instant) if isinstance(instant, datetime) else instant
    return df.where(F.col(column) >= instant - F.make_dt_interval(mins=F.lit(minutes)))


def latency_over_time(
    det: DataFrame, minutes: int | None = 15, now: Column | datetime | None = None
) -> DataFrame:
    """Median, p95 and maximum latency per minute of processing."""
    recent = since(det, "processed_at", minutes, now).select(
        minute_of(F.col("processed_at")).alias("minute"), "latency_seconds"
    )
    ranks = exact_quantiles(
        recent, "latency_seconds", {"p50": 0.50, "p95": 0.95, "p100": 1.0}, by=["minute"]
    )
    return ranks.select(
        "minute",
        F.round("p50", 2).alias("p50_s"),
        F.round("p95", 2).alias("p95_s"),
        F.round("p100", 2).alias("max_s"),
    ).orderBy("minute")


def throughput(
    counts: DataFrame, minutes: int | None = 15, now: Column | datetime | None = None
) -> DataFrame:
    recent = since(counts, "batch_time", minutes, now).where(~has_reserved_prefix())
    return (
        recent.groupBy("batch_time")
        .agg(total(F.col("record_count")).alias("records"))
        .orderBy("batch_time")
    )


def event_time_formats(zone: str = DISPLAY_TIME_ZONE) -> list[Column]:
    """The three display formats of a record's event time."""
    return [
        display_time(event_instant(), MINUTE_FORMAT, zone).alias("minute_text"),
        display_time(event_instant(), SECOND_FORMAT, zone).alias("second_text"),
        display_time(event_instant(), CLOCK_FORMAT, zone).alias("clock_text"),
    ]


# --- batch health -----------------------------------------------------------

def malformed_by_kind(counts: DataFrame) -> DataFrame:
    return (
        counts.where(has_reserved_prefix())
        .groupBy(failure_kind().alias("failure_kind"))
        .agg(total(F.col("record_count")).alias("records"))
    )


def batch_health(counts: DataFrame) -> DataFrame:
    """Per batch: usable, unparseable and incomplete messages."""
    n = F.col("record_count")
    broken = F.col("label").isin(UNPARSEABLE, INCOMPLETE)
    return (
        counts.groupBy(*batch_key(counts))
        .agg(
            total(F.when(~broken, n)).alias("valid"),
            total(F.when(F.col("label") == UNPARSEABLE, n)).alias("unparseable"),
            total(F.when(F.col("label") == INCOMPLETE, n)).alias("incomplete"),
            total(n).alias("messages"),
        )
        .withColumn(
            "malformed_pct",
            100 * ratio(F.col("unparseable") + F.col("incomplete"), F.col("messages")),
        )
    )


def malformed_running(health: DataFrame) -> DataFrame:
    """Cumulative malformed totals in batch order, each run for itself."""
    key = batch_key(health)
    return running_totals(
        health.select(*key, "unparseable", "incomplete"),
        "batch_id",
        {"unparseable_so_far": "unparseable", "incomplete_so_far": "incomplete"},
        by=key[:-1],
    )


def idle_streaks(batches: DataFrame, notice_every: int = 30) -> DataFrame:
    """Runs of consecutive batch ids that carried no records.

    ``batches`` has (batch_id, records).  An idle batch may be listed with zero
    records or be absent; a streak is simply the gap between two busy ids, so
    idle ids are never generated.  The listed id range bounds the first and
    last streak.  A notice is due on the first idle batch and on every
    ``notice_every``-th.
    """
    ends = batches.agg(F.min("batch_id").alias("low"), F.max("batch_id").alias("high")).where(
        F.col("low").isNotNull()
    )
    fences = ends.select(F.explode(F.array(F.col("low") - 1, F.col("high") + 1)).alias("batch_id"))
    busy = batches.where(F.col("records") > 0).select("batch_id")
    marks = busy.unionByName(fences).distinct()
    gap = F.col("batch_id") - F.col("previous") - 1
    return (
        previous_value(marks, "batch_id")
        .where(gap > 0)
        .select(
            (F.col("previous") + 1).alias("first_idle"),
            (F.col("batch_id") - 1).alias("last_idle"),
            gap.alias("idle_batches"),
            (F.lit(int(notice_every > 1)) + F.floor(gap / F.lit(notice_every))).cast("bigint").alias("notices"),
        )
    )


def batch_cost_fit(batches: DataFrame) -> DataFrame:
    """Least-squares line of batch milliseconds on batch records.

    ``batches`` has (records, batch_ms); empty batches are left out, as they
    skip the work the line is about.
    """
    return (
        batches.where(F.col("records") > 0)
        .agg(
            F.count(F.lit(1)).alias("batches"),
            F.regr_slope("batch_ms", "records").alias("ms_per_record"),
            F.regr_intercept("batch_ms", "records").alias("fixed_ms"),
        )
    )
