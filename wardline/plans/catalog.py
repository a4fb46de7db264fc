"""Every query by name: a callable from (session, data folder) to a DataFrame.

The callables only bind operators to the given tables and fix the presentation
(arrays and times as text, computed doubles to six places).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wardline.functions.expressions import (
    SECOND_FORMAT,
    count_where,
    each_of,
    listed,
    minute_of,
)
from wardline.functions.running import one_row
from wardline.operators import decode, monitoring, prepare, rollups, scoring
from wardline.operators.rules import evaluate
from wardline.operators.shipped_rules import shipped_rules
from wardline.plans import rulesets
from wardline.plans.staging import folder_once, written_once
from wardline.schema import (
    COUNT_LABEL_COLUMN,
    COUNTS_SCHEMA,
    RECORD_FIELDS,
    STATUS_COLUMN,
    VERDICT_FIELDS,
    detections_schema,
)
from wardline.session import prepare_session, shared_dir
from wardline.sources import adapters
from wardline.sources.messages import file_stream
from wardline.sources.tables import read_table
from wardline.streaming.job import run_available, run_id_of
from wardline.streaming.progress import ProgressLog
from wardline.streaming.report import export_report, report_parts
from wardline.streaming.store import Store
from wardline.streaming.windows import closed_windows, closing_alerts, horizon, start_closing, still_open

Query = Callable[[SparkSession, str], DataFrame]


#: Messages laid down in one file, unless there are fewer files than cores.
LAID_DOWN_ROWS = 100_000


class Views:
    """The given tables as the views the operators work on."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = prepare_session(spark)
        self.directory = directory

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.directory, name)

    @cached_property
    def events(self) -> DataFrame:
        return adapters.event_view(self.table("events"))

    @cached_property
    def judged_events(self) -> DataFrame:
        return evaluate(self.events, rulesets.event_rules())

    @cached_property
    def judged_records(self) -> DataFrame:
        """Typed records with verdicts, without the way through messages."""
        rules = shipped_rules()
        read = sorted({c.field for rule in rules for c in rule.conditions})
        return evaluate(adapters.record_view(self.table("events"), [*read, "timestamp", "label"]), rules)

    def _written(self, name: str, schema: StructType, build: Callable[[], DataFrame]) -> DataFrame:
        return written_once(self.spark, self.directory, "events", name, schema, build)

    @cached_property
    def messages(self) -> DataFrame:
        """Events as JSON messages, laid down like a topic."""
        def laid_down() -> DataFrame:
            # A topic has partitions for all cores; one file would be written and decoded by one of them.
            # The narrow events are dealt out, not the wide messages, so that all cores build messages too.
            events, cores = self.table("events"), self.spark.sparkContext.defaultParallelism
            if len(events.inputFiles()) < cores:
                events = events.repartition(max(cores, -(-events.count() // LAID_DOWN_ROWS)))
            return adapters.message_view(events)

        return self._written("messages", adapters.MESSAGE_TABLE, laid_down)

    @cached_property
    def parsed(self) -> DataFrame:
        return decode.parse_messages(self.messages, keep=("event_id", "batch_id", "processed_at"))

    @cached_property
    def judged(self) -> DataFrame:
        return evaluate(self.parsed, shipped_rules())

    def detect(self) -> DataFrame:
        """Detections of all micro-batches, from the messages."""
        return prepare.detections(self.judged, F.col("batch_id"), F.col("processed_at"))

    def count(self) -> DataFrame:
        """Counts of all micro-batches, from the messages."""
        return prepare.traffic_counts(self.parsed, F.col("batch_id"), F.col("processed_at"))

    @cached_property
    def det(self) -> DataFrame:
        return self._written(
            "detections", detections_schema(), lambda: prepare.sort_for_storage(self.detect())
        )

    @cached_property
    def counts(self) -> DataFrame:
        return self._written("traffic_counts", COUNTS_SCHEMA, self.count)

    @property
    def now(self) -> Column:
        """The newest batch of the data, in place of the wall clock."""
        return self.counts.agg(F.max("batch_time").alias("t")).scalar()


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in names})


def texts(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as text, so that no client time zone can shift them."""
    return df.withColumns({name: F.date_format(name, SECOND_FORMAT) for name in names})


def lists(df: DataFrame) -> DataFrame:
    return df.withColumns({n: listed(n) for n in ("matched_rule_ids", "matched_attack_types")})


# --- rules ------------------------------------------------------------------

def _rule_hits(judged: DataFrame) -> DataFrame:
    sets = judged.groupBy("matched_rule_ids").agg(F.count(F.lit(1)).alias("rows"))
    return (
        each_of(sets, "matched_rule_ids", "rule_id", "rows")
        .groupBy("rule_id")
        .agg(F.sum("rows").alias("matches"))
    )


def rule_ops(v: Views) -> DataFrame:
    documents = v.table("documents").select("n_chars", "lang", "source")
    numbers = evaluate(v.events, rulesets.number_operator_rules())
    words = evaluate(documents, rulesets.text_operator_rules())
    return _rule_hits(numbers).unionByName(_rule_hits(words))


def rule_nulls(v: Views) -> DataFrame:
    sparse = v.events.withColumns(
        {
            "k": F.when(F.col("k") >= 20, F.col("k")),
            "value": F.when(F.col("hour") >= 6, F.col("value")),
        }
    )
    judged = evaluate(sparse, rulesets.null_rules())
    return judged.groupBy(
        F.col("k").isNull().alias("k_null"),
        F.col("value").isNull().alias("value_null"),
        listed("matched_rule_ids").alias("rules_fired"),
        "max_severity",
        "is_detection",
    ).agg(F.count(F.lit(1)).alias("events"))


def rules_empty(v: Views) -> DataFrame:
    judged = evaluate(v.events, [])
    return judged.agg(
        F.count(F.lit(1)).alias("events"),
        count_where(F.size("matched_rule_ids") == 0).alias("no_rules"),
        count_where(F.size("matched_attack_types") == 0).alias("no_types"),
        count_where(F.col("max_severity").isNull()).alias("no_severity"),
        count_where(F.col("is_detection")).alias("detections"),
    )


def rules_evaluate(v: Views) -> DataFrame:
    return lists(v.judged_records.select("event_id", "label", *VERDICT_FIELDS))


def line_outcomes(v: Views) -> DataFrame:
    """Rules on order lines: severity and class of what fired."""
    judged = evaluate(adapters.line_view(v.table("lineitem")), rulesets.line_rules())
    return judged.groupBy(
        "label", listed("matched_attack_types").alias("detected_as"), "max_severity"
    ).agg(F.count(F.lit(1)).alias("lines"))


def document_outcomes(v: Views) -> DataFrame:
    """Rules on documents whose class comes from a second table."""
    labelled = adapters.document_view(v.table("documents"), v.table("labels"))
    return scoring.outcome_per_label(evaluate(labelled, rulesets.document_rules()))


# --- decoding and preparation ----------------------------------------------

def parse_classify(v: Views) -> DataFrame:
    return v.parsed.select("event_id", *RECORD_FIELDS, STATUS_COLUMN, COUNT_LABEL_COLUMN)


def fields_present(v: Views) -> DataFrame:
    return v.parsed.select("event_id", decode.fields_present().cast("bigint").alias("fields_present"))


def latency_stamp(v: Views) -> DataFrame:
    return texts(v.detect().select("timestamp", "batch_id", "processed_at", "latency_seconds"), "processed_at")


def verdicts(v: Views) -> DataFrame:
    return monitoring.with_verdict(v.judged_events).select(
        "event_id", "label", listed("matched_attack_types").alias("detected_as"),
        "verdict", "problem_rank",
    )


def event_time_format(v: Views) -> DataFrame:
    records = adapters.record_view(v.table("events"), ["timestamp"])
    return records.select("event_id", *monitoring.event_time_formats())


# --- monitoring -------------------------------------------------------------

def _alerts(v: Views) -> DataFrame:
    return monitoring.alerts(v.det)


def _raw(v: Views) -> DataFrame:
    return monitoring.raw_rows(v.det, row_key=("timestamp",))


def alert_raw(v: Views) -> DataFrame:
    rows = monitoring.latest_raw_rows(
        _raw(v), row_key=("timestamp", "actual_label", "service", "src_bytes", "dst_bytes")
    )
    return texts(rows.drop("window_start_ts"), "event_ts")


def alert_drilldown(v: Views) -> DataFrame:
    false_alarms = monitoring.only_verdict(_alerts(v))
    return texts(monitoring.drill_down(_raw(v), false_alarms).drop("window_start_ts"), "event_ts")


def latency_over_time(v: Views) -> DataFrame:
    return texts(monitoring.latency_over_time(v.det, now=v.now), "minute")


def throughput(v: Views) -> DataFrame:
    return texts(monitoring.throughput(v.counts, now=v.now), "batch_time")


def idle_streaks(v: Views) -> DataFrame:
    busy = v.events.groupBy("batch_id").agg(F.count(F.lit(1)).alias("records"))
    return monitoring.idle_streaks(busy)


def batch_cost_fit(v: Views) -> DataFrame:
    """Batch time here is from a minute's first event to its processing."""
    span = F.unix_micros(F.max("processed_at")) - F.unix_micros(F.min("ts"))
    batches = v.events.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("records"), (span / F.lit(1000.0)).alias("batch_ms")
    )
    return rounded(monitoring.batch_cost_fit(batches), "ms_per_record", "fixed_ms", places=4)


# --- runs, store and stream -------------------------------------------------

#: Rules of the second stored run: all but the last.
FEWER_RULES = shipped_rules()[:-1]


def _two_runs(v: Views) -> Store:
    """A store of two runs over the same messages: in two batches, and in one with fewer rules."""

    def fill(folder: str) -> None:
        store = Store(v.spark, folder)
        store.ensure_tables()
        early, rows = F.minute("processed_at") < 30, ("event_id", "batch_id", "processed_at")
        for batch, part in enumerate((early, ~early)):
            judged = evaluate(v.parsed.where(part).drop(*rows), shipped_rules())
            store.write_batch(judged, batch, "a", datetime(2024, 1, 30 + batch, 12, tzinfo=timezone.utc))
        judged = evaluate(v.parsed.drop(*rows), FEWER_RULES)
        store.write_batch(judged, 0, "b", datetime(2024, 2, 1, 12, tzinfo=timezone.utc))
        store.compact(date(2024, 1, 30))

    return Store(v.spark, folder_once(v.spark, v.directory, "events", "two-runs", fill))


def runs_batch_window(v: Views) -> DataFrame:
    return texts(scoring.batch_window(_two_runs(v).counts()), "first_seen", "last_seen")


def runs_batch_health(v: Views) -> DataFrame:
    return rounded(monitoring.batch_health(_two_runs(v).counts()), "malformed_pct")


def runs_malformed_running(v: Views) -> DataFrame:
    return monitoring.malformed_running(monitoring.batch_health(_two_runs(v).counts()))


def run_compare(v: Views) -> DataFrame:
    """Two stored runs, the second with a rule less."""
    store = _two_runs(v)
    left, right = (
        scoring.long_metrics(store.detections(run_id=run), store.counts(run_id=run)) for run in ("a", "b")
    )
    return rounded(scoring.run_compare(left, right), "left_value", "right_value", "delta")


def _one_batch(v: Views) -> tuple[Store, DataFrame]:
    store = Store(v.spark, shared_dir(v.spark, "store"))
    store.ensure_tables()
    return store, v.judged.drop("event_id", "batch_id", "processed_at")


def sink_roundtrip(v: Views) -> DataFrame:
    """What was stored as one batch against the same rows prepared anew."""
    store, rows = _one_batch(v)
    store.write_batch(rows, 0)
    return store.round_trip("main", v.det)


def _sizes(moment: str, store: Store) -> DataFrame:
    sized = scoring.table_counts(store.detections(), store.counts())
    return sized.select(F.lit(moment).alias("moment"), "*")


def reset_tables(v: Views) -> DataFrame:
    """Row counts before and after a reset; the batch before it is the whole data."""
    store, rows = _one_batch(v)
    store.write_batch(rows, 0)
    before = v.spark.createDataFrame(_sizes("before reset", store).toArrow())  # two rows
    store.reset()
    return before.unionByName(_sizes("after reset", store))


def delete_batch(v: Views) -> DataFrame:
    """The data stored as two batches, one of them deleted again."""
    store = Store(v.spark, shared_dir(v.spark, "store"))
    store.ensure_tables()
    early, rows = F.minute("processed_at") < 30, ("event_id", "batch_id", "processed_at")
    for batch, part in enumerate((early, ~early)):
        store.write_batch(v.judged.where(part).drop(*rows), batch)
    store.delete_batch(1)
    return store.counts().groupBy("batch_id", "label").agg(
        F.sum("record_count").alias("record_count")
    )


def delete_compacted(v: Views) -> DataFrame:
    """Batches deleted and replayed once their day is compacted, and one deleted of an open day.

    What is left is the later half of the data, once.
    """
    store = Store(v.spark, shared_dir(v.spark, "store"))
    store.ensure_tables()
    early, rows = F.minute("processed_at") < 30, ("event_id", "batch_id", "processed_at")
    parts = [v.judged.where(early).drop(*rows), v.judged.where(~early).drop(*rows)]
    closed, opened = (datetime(2024, 1, day, 12, tzinfo=timezone.utc) for day in (30, 31))
    store.write_batch(parts[0], 0, now=closed)
    store.write_batch(parts[1], 1, now=closed)
    store.write_batch(parts[0], 2, now=opened)
    store.compact(closed.date())
    store.delete_batch(0)
    store.write_batch(parts[1], 1, now=closed)
    store.delete_batch(2)
    snapshot = store.snapshot()
    stored = snapshot.detections().groupBy("batch_id", "label").agg(F.count(F.lit(1)).alias("stored"))
    return snapshot.counts().groupBy("batch_id", "label").agg(F.sum("record_count").alias("record_count")).join(
        stored, ["batch_id", "label"], "left"
    ).withColumn("stored", F.coalesce("stored", F.lit(0)))


def alerts_rollup(v: Views) -> DataFrame:
    """Alerts of a stored run from what its batches added to them."""
    return texts(_two_runs(v).snapshot().alerts("a"), "window_start_ts")


def latency_rollup(v: Views) -> DataFrame:
    """Latency per minute of a stored run from sketches, and whether their ranks are as near as promised."""
    snapshot = _two_runs(v).snapshot()
    found = snapshot.latency_over_time(run_id="a")
    rows = snapshot.detections("a").select(minute_of(F.col("processed_at")).alias("minute"), "latency_seconds")
    near = []
    for name, p in rollups.LATENCY_QUANTILES.items():
        # the value is rounded to two places, so it stands for whatever rounds to it
        below, upto = (F.count_if(F.col("latency_seconds") <= F.col(name) + d) / F.count("latency_seconds") for d in (-0.005, 0.005))
        near.append(((below - rollups.RANK_ERROR <= p) & (upto + rollups.RANK_ERROR >= p)).alias(name.replace("_s", "_near")))
    return texts(rows.join(found, "minute").groupBy("minute", "max_s").agg(*near), "minute")


def drilldown_stored(v: Views) -> DataFrame:
    """Stored rows around the false alarms of a run, from the files of their minutes only."""
    snapshot = _two_runs(v).snapshot()
    rows = snapshot.around(monitoring.only_verdict(snapshot.alerts("a")), "a")
    raw = monitoring.raw_rows(rows, row_key=("timestamp",)).drop("window_start_ts", "latency_s")
    return texts(raw, "event_ts")


def report_export(v: Views) -> DataFrame:
    """Every part of the exported report read back: a row per part, label and figure."""
    folder = shared_dir(v.spark, "report")
    export_report(v.det, v.counts, folder)
    out = None
    for name, part in report_parts(v.det, v.counts).items():
        back = v.spark.read.schema(part.schema).json(f"{folder}/{name}")
        keys = [F.col(c) for c in ("check_name", "label") if c in part.columns]
        figures = [c for c, kind in part.dtypes if kind in ("bigint", "double", "boolean")]
        rows = back.select(
            F.lit(name).alias("part"),
            F.concat_ws("/", *keys).alias("item"),
            F.explode(F.array(*[
                F.struct(F.lit(c).alias("figure"), F.round(F.col(f"`{c}`").cast("double"), 6).alias("value")) for c in figures
            ])).alias("cell"),
        ).select("part", "item", "cell.*")
        out = rows if out is None else out.unionByName(rows)
    return out.where("value IS NOT NULL")


#: Least bounds of a micro-batch of the stream queries: files, and messages in a file.
BATCH_FILES, FILE_MESSAGES = 4, 2500

#: A long backlog is caught up in about so many micro-batches, each with at most so many messages a core.
CATCH_UP_BATCHES, CORE_MESSAGES = 20, 250_000


@dataclass(frozen=True)
class Bounds:
    """Of a micro-batch: files, and messages in a file."""

    files: int
    messages: int

    @property
    def ceiling(self) -> int:
        return self.files * self.messages


def batch_bounds(backlog: int, cores: int) -> Bounds:
    """What a micro-batch takes of a backlog; a batch costs a second or more, whatever it holds.

    A gzip file is read by one core, so a larger batch has a file for each.
    """
    least = BATCH_FILES * FILE_MESSAGES
    batch = min(backlog // CATCH_UP_BATCHES, cores * CORE_MESSAGES)
    if batch <= least:
        return Bounds(BATCH_FILES, FILE_MESSAGES)
    files = max(BATCH_FILES, cores)
    return Bounds(files, -(-batch // files))


def _bounds(v: Views) -> Bounds:
    return batch_bounds(v.messages.count(), v.spark.sparkContext.defaultParallelism)


def _live(v: Views) -> tuple[str, Store, str]:
    root = shared_dir(v.spark, "live")
    return f"{root}/in", Store(v.spark, f"{root}/store"), f"{root}/checkpoint"


def _deliver(messages: DataFrame, source: str, bounds: Bounds) -> None:
    """Leave messages as text files of bounded length."""
    writer = messages.select("value").write.mode("append").option("compression", "gzip")
    writer.option("maxRecordsPerFile", bounds.messages).text(source)


def _drain(v: Views, source: str, store: Store, checkpoint: str, bounds: Bounds) -> StreamingQuery:
    """Stream what is new in the source, in micro-batches of bounded size."""
    return run_available(file_stream(v.spark, source, max_files=bounds.files), shipped_rules(), store, checkpoint)


def _deliver_and_drain(
    v: Views, messages: DataFrame, source: str, store: Store, checkpoint: str, bounds: Bounds | None = None
) -> StreamingQuery:
    bounds = bounds or _bounds(v)
    _deliver(messages, source, bounds)
    return _drain(v, source, store, checkpoint, bounds)


def stream_ingest(v: Views) -> DataFrame:
    """What bounded micro-batches counted, malformed messages included."""
    source, store, checkpoint = _live(v)
    _deliver_and_drain(v, v.messages, source, store, checkpoint)
    return store.counts().groupBy("label").agg(F.sum("record_count").alias("record_count"))


def stream_detect(v: Views) -> DataFrame:
    source, store, checkpoint = _live(v)
    _deliver_and_drain(v, v.messages, source, store, checkpoint)
    return store.round_trip(run_id_of(v.spark, checkpoint), v.det)


def stream_resume(v: Views) -> DataFrame:
    """Two runs on one checkpoint; messages arrive before each of them."""
    source, store, checkpoint = _live(v)
    early = F.minute("processed_at") < 30
    for part in (v.messages.where(early), v.messages.where(~early)):
        _deliver_and_drain(v, part, source, store, checkpoint)
    return store.counts().groupBy("label").agg(
        F.count_distinct("run_id").alias("runs"), F.sum("record_count").alias("record_count")
    )


def stream_progress(v: Views) -> DataFrame:
    """Per run of a stream what its batches read; the second run finds nothing new.

    Spark's reports say which run a batch belongs to.  Their row counts add up what tasks read,
    and so count twice what is evaluated twice; the store's own totals of the batch do not.
    """
    source, store, checkpoint = _live(v)
    bounds = _bounds(v)
    _deliver(v.messages, source, bounds)
    log = ProgressLog(v.spark, f"{checkpoint}-progress")
    v.spark.streams.addListener(log)
    try:
        runs = [str(_drain(v, source, store, checkpoint, bounds).runId) for _ in range(2)]
        reports = log.table()
    finally:
        v.spark.streams.removeListener(log)
    numbered = F.create_map(*[F.lit(x) for i, run in enumerate(runs) for x in (run, i + 1)])
    started = v.spark.createDataFrame([(i + 1,) for i in range(len(runs))], "run int")
    batches = reports.select(F.element_at(numbered, F.col("query_run")).alias("run"), "batch_id").distinct()
    read = batches.join(store.batches(run_id_of(v.spark, checkpoint)), "batch_id").groupBy("run").agg(
        F.sum("messages").alias("records"),
        F.count_if(F.col("messages") > bounds.ceiling).alias("over_ceiling"),
    )
    return started.join(read, "run", "left").select(
        "run",
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("over_ceiling", F.lit(0)).alias("over_ceiling"),
        (F.coalesce("records", F.lit(0)) == 0).alias("caught_up"),
    )


def stream_batches(v: Views) -> DataFrame:
    """What a stream's batches left in the store's own table of them, and a line through their cost."""
    source, store, checkpoint = _live(v)
    bounds = _bounds(v)
    _deliver_and_drain(v, v.messages, source, store, checkpoint, bounds)
    batches = store.batches(run_id_of(v.spark, checkpoint))
    cost = monitoring.batch_cost_fit(batches.select(F.col("messages").alias("records"), "batch_ms"))
    sums = batches.agg(*[F.sum(c).alias(c) for c in ("messages", "valid", "unparseable", "incomplete")])
    more = batches.where("messages > 0").agg(F.countDistinct("messages").alias("kinds"))
    fitted = one_row(sums, one_row(cost, more))
    return fitted.select(
        "messages", "valid", "unparseable", "incomplete",
        (F.col("batches") >= F.ceil(F.col("messages") / F.lit(bounds.ceiling))).alias("batches_bounded"),
        ((F.col("kinds") < 2) | F.col("ms_per_record").isNotNull()).alias("cost_known"),
    )


#: How long the windows of ``stream_alerts`` wait: rows are late by ten minutes and one at most.
ALERT_DELAY = "15 minutes"


def stream_alerts(v: Views) -> DataFrame:
    """Alerts as a stream closes them, in two runs on one checkpoint, and those still open from the rows."""
    root, clock = shared_dir(v.spark, "live"), F.unix_micros("processed_at")
    middle = v.det.agg(((F.min(clock) + F.max(clock)) / 2).alias("t")).scalar()
    for part in (v.det.where(clock < middle), v.det.where(clock >= middle)):
        part.write.mode("append").parquet(f"{root}/in")
        rows = v.spark.readStream.schema(v.det.schema).parquet(f"{root}/in")
        frame = closing_alerts(rows, ALERT_DELAY)
        query = start_closing(frame, f"{root}/out", f"{root}/checkpoint")
        query.awaitTermination()
    minute = F.timestamp_seconds(F.floor(F.col("timestamp") / 60) * 60)
    tail = v.det.where(still_open(minute, horizon(query)))
    return texts(
        rollups.alerts_of(closed_windows(frame, f"{root}/out")).unionByName(monitoring.alerts(tail)), "window_start_ts"
    )


QUERIES: dict[str, Callable[[Views], DataFrame]] = {
    # rules
    "rule_ops": rule_ops,
    "rule_nulls": rule_nulls,
    "rules_empty": rules_empty,
    "rules_evaluate": rules_evaluate,
    "line_outcomes": line_outcomes,
    "document_outcomes": document_outcomes,
    # decoding and preparation
    "parse_classify": parse_classify,
    "fields_present": fields_present,
    "counts_per_batch": lambda v: texts(v.count(), "batch_time"),
    "detections": lambda v: texts(lists(v.detect()), "processed_at"),
    "latency_stamp": latency_stamp,
    # scoring
    "outcome_per_label": lambda v: scoring.outcome_per_label(v.det),
    "attribution": lambda v: scoring.attribution(v.det),
    "traffic_totals": lambda v: scoring.traffic_totals(v.counts),
    "malformed_totals": lambda v: scoring.malformed_totals(v.counts),
    "malformed_rate": lambda v: scoring.malformed_rate(v.counts),
    "latency_summary": lambda v: rounded(
        scoring.latency_summary(v.det), "mean", "p50", "p95", "p99", "max", "min"
    ),
    "batch_window": lambda v: texts(scoring.batch_window(v.counts), "first_seen", "last_seen"),
    "confusion": lambda v: scoring.confusion(v.det, v.counts),
    "overall_metrics": lambda v: scoring.overall_metrics(v.det, v.counts),
    "label_metrics": lambda v: scoring.label_metrics(v.det, v.counts),
    "integrity": lambda v: rounded(scoring.integrity(v.det, v.counts), "expected", "actual"),
    "table_counts": lambda v: scoring.table_counts(v.det, v.counts),
    "storage_ratio": lambda v: scoring.storage_ratio(v.det, v.counts),
    "baseline_accuracy": lambda v: rounded(scoring.baseline_accuracy(v.det, v.counts), "lift"),
    "class_mix": lambda v: scoring.class_mix(v.counts),
    "fp_by_rule": lambda v: scoring.false_positives_by_rule(v.det, v.counts),
    "runs_batch_window": runs_batch_window,
    "runs_batch_health": runs_batch_health,
    "runs_malformed_running": runs_malformed_running,
    "run_compare": run_compare,
    "offline_score": lambda v: scoring.offline_score(v.judged_records),
    "offline_fp_rate": lambda v: scoring.offline_fp_rate(v.judged_records),
    "attribution_mismatch": lambda v: scoring.attribution_mismatch(v.judged_events),
    # monitoring
    "verdicts": verdicts,
    "volume_kpis": lambda v: monitoring.volume_kpis(v.det, v.counts),
    "accuracy_kpis": lambda v: monitoring.accuracy_kpis(v.det, v.counts),
    "alerts": lambda v: texts(_alerts(v), "window_start_ts"),
    "alerts_top": lambda v: texts(monitoring.top_alerts(_alerts(v)), "window_start_ts"),
    "alerts_false_positive": lambda v: texts(monitoring.only_verdict(_alerts(v)), "window_start_ts"),
    "alert_raw": alert_raw,
    "alert_drilldown": alert_drilldown,
    "recall_by_type": lambda v: monitoring.recall_by_type(v.det),
    "precision_by_type": lambda v: monitoring.precision_by_type(v.det),
    "latency_over_time": latency_over_time,
    "throughput": throughput,
    "event_time_format": event_time_format,
    "malformed_by_kind": lambda v: monitoring.malformed_by_kind(v.counts),
    "batch_health": lambda v: rounded(monitoring.batch_health(v.counts), "malformed_pct"),
    "malformed_running": lambda v: monitoring.malformed_running(monitoring.batch_health(v.counts)),
    "idle_streaks": idle_streaks,
    "batch_cost_fit": batch_cost_fit,
    # store and stream
    "sink_roundtrip": sink_roundtrip,
    "reset_tables": reset_tables,
    "delete_batch": delete_batch,
    "delete_compacted": delete_compacted,
    "alerts_rollup": alerts_rollup,
    "latency_rollup": latency_rollup,
    "drilldown_stored": drilldown_stored,
    "report_export": report_export,
    "stream_ingest": stream_ingest,
    "stream_detect": stream_detect,
    "stream_resume": stream_resume,
    "stream_progress": stream_progress,
    "stream_batches": stream_batches,
    "stream_alerts": stream_alerts,
}


def registered() -> dict[str, Query]:
    def bind(build: Callable[[Views], DataFrame]) -> Query:
        return lambda spark, directory: build(Views(spark, directory))

    return {name: bind(build) for name, build in QUERIES.items()}
