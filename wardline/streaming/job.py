"""Wiring of the live job: messages -> records -> verdicts -> store."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardline.functions.expressions import total
from wardline.operators.decode import parse_messages
from wardline.operators.rules import Rule, evaluate
from wardline.schema import REQUIRED_FIELDS
from wardline.sources import files
from wardline.streaming.progress import ProgressLog
from wardline.streaming.store import BatchTotals, Store

LOG = logging.getLogger("wardline")

#: Default cadence of micro-batches (a fixed value).
DEFAULT_TRIGGER = "1 second"

#: An idle stream is reported on its first idle batch and every so many after it (a fixed value).
IDLE_NOTICE_EVERY = 30


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The run id kept inside a checkpoint: same checkpoint, same run.

    A wiped checkpoint restarts batch ids at zero and gets a new run id, so it
    cannot overwrite the batches of the previous run.
    """
    path = f"{checkpoint.rstrip('/')}/wardline_run"
    files.create(spark, path, uuid.uuid4().hex)
    return files.read(spark, path)


class BatchLog:
    """One line per batch with its share of broken messages and the run's totals so far; idle streaks now and then."""

    def __init__(self, idle_every: int = IDLE_NOTICE_EVERY):
        self.idle_every = idle_every
        self.unparseable = self.incomplete = self.idle = 0

    @classmethod
    def resumed(cls, store: Store, run_id: str, idle_every: int = IDLE_NOTICE_EVERY) -> BatchLog:
        """A log that goes on where the run's stored batches end: its totals and its streak of idle batches."""
        log, busy = cls(idle_every), F.col("messages") > 0
        log.unparseable, log.incomplete, first, last, last_busy = store.batches(run_id).agg(
            total(F.col("unparseable")), total(F.col("incomplete")),
            F.min("batch_id"), F.max("batch_id"), F.max(F.when(busy, F.col("batch_id"))),
        ).first()
        if last is not None:
            log.idle = last - (first - 1 if last_busy is None else last_busy)
        return log

    def note(self, batch_id: int, totals: BatchTotals) -> None:
        if not totals.messages:
            self.idle += 1
            if self.idle == 1 or self.idle % self.idle_every == 0:
                LOG.info("batch %d: no messages, %d idle batches in a row", batch_id, self.idle)
            return
        self.idle = 0
        broken = totals.unparseable + totals.incomplete
        self.unparseable += totals.unparseable
        self.incomplete += totals.incomplete
        LOG.log(
            logging.WARNING if broken else logging.INFO,
            "batch %d: %d messages, %d unparseable, %d incomplete (%.2f%%); so far %d unparseable, %d incomplete",
            batch_id, totals.messages, totals.unparseable, totals.incomplete, 100 * broken / totals.messages,
            self.unparseable, self.incomplete,
        )


def progress_folder(store: Store) -> str:
    return f"{store.base}/progress"


def start_detection(
    messages: DataFrame,
    rules: Sequence[Rule],
    store: Store,
    checkpoint: str,
    trigger: str | None = DEFAULT_TRIGGER,
    required: Sequence[str] = REQUIRED_FIELDS,
    reset_first: bool = False,
    decode_partitions: int | None = None,
) -> StreamingQuery:
    """Start the stream; ``trigger=None`` processes what is there and stops.

    ``decode_partitions`` spreads the messages over that many tasks first, for
    sources that deliver fewer splits than the cluster has cores.

    Malformed messages travel along as rows of nulls - no rule can fire on
    them - and are counted with everything else in one aggregation.  Each batch
    leaves a row in ``store.batches``; Spark's own reports are kept below the
    store's root (``progress_folder``), the last ones when the query ends.
    """
    spark = store.spark
    run_id = run_id_of(spark, checkpoint)
    if reset_first:
        store.reset()
    else:
        store.ensure_tables()
    if decode_partitions:
        messages = messages.repartition(decode_partitions)
    # Rules are part of the stream's own plan: compiled once, not per batch.
    judged = evaluate(parse_messages(messages, store.record_schema, required), rules)

    log = BatchLog.resumed(store, run_id)
    name = f"detection-{run_id}"
    ProgressLog.attached(spark, progress_folder(store), name)

    def process(batch: DataFrame, batch_id: int) -> None:
        log.note(batch_id, store.write_batch(batch, batch_id, run_id))

    writer = judged.writeStream.queryName(name).foreachBatch(process).option("checkpointLocation", checkpoint)
    if trigger is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def run_available(
    messages: DataFrame, rules: Sequence[Rule], store: Store, checkpoint: str, **settings
) -> StreamingQuery:
    """Process everything available now and return the finished query."""
    query = start_detection(messages, rules, store, checkpoint, trigger=None, **settings)
    query.awaitTermination()
    return query
