"""Progress of a running stream as rows, and a watcher that logs it."""

from __future__ import annotations

import json
import logging
import time
from threading import Lock
from typing import Any, ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

LOG = logging.getLogger("wardline")

PROGRESS_SCHEMA = (
    "batch_id bigint, records bigint, records_per_second double, batch_ms bigint, "
    "start_offset string, end_offset string"
)

#: Without a finished batch for this long, the stream is worth a warning.
STALL_SECONDS = 60


LOG_SCHEMA = (
    "query_run string, batch_id bigint, source int, description string, records bigint, batch_records bigint, "
    "batch_ms bigint, start_offset string, end_offset string"
)


def text(offset: Any) -> str | None:
    return None if offset is None else json.dumps(offset, sort_keys=True)


class ProgressLog(StreamingQueryListener):
    """Keeps every progress report as rows of a stored table, one per batch and source.

    Spark itself remembers only the last reports of a query.  Rows are held back
    until there are ``at_once`` of them, the oldest has waited ``seconds``, or the
    query ends, so that a short trigger does not write a file per batch.  A log with
    ``names`` keeps the reports of queries of these names only, any other those of all.
    """

    _attached: ClassVar[dict[tuple[str, str], ProgressLog]] = {}

    def __init__(self, spark: SparkSession, folder: str, at_once: int = 1000, seconds: float = 30.0):
        self.spark, self.folder, self.at_once, self.seconds = spark, folder, at_once, seconds
        self.names: set[str] = set()
        self.over = False
        self._active: set[str] = set()
        self._rows: list[tuple] = []
        self._since = time.monotonic()
        self._lock = Lock()

    @classmethod
    def attached(cls, spark: SparkSession, folder: str, name: str) -> ProgressLog:
        """The log of a folder, listening to the query of a name; one for all queries that report there."""
        key = (spark.sparkContext.applicationId, folder)
        for other in [k for k, log in cls._attached.items() if log.over and k != key]:
            spark.streams.removeListener(cls._attached.pop(other))  # not from its own callback
        log = cls._attached.get(key) or cls(spark, folder)
        log.over = False
        log.names.add(name)
        if key not in cls._attached:
            cls._attached[key] = log
            spark.streams.addListener(log)
        return log

    def onQueryStarted(self, event: Any) -> None:
        if event.name in self.names:
            self._active.add(str(event.runId))

    def onQueryProgress(self, event: Any) -> None:
        if self.names and event.progress.name not in self.names:
            return
        report = json.loads(event.progress.json)
        rows = [
            (
                report["runId"], report["batchId"], number, source.get("description"), source.get("numInputRows"),
                report.get("numInputRows"), (report.get("durationMs") or {}).get("triggerExecution"),
                text(source.get("startOffset")), text(source.get("endOffset")),
            )
            for number, source in enumerate(report.get("sources") or [{}])
        ]
        with self._lock:
            if not self._rows:
                self._since = time.monotonic()
            self._rows += rows
            due = len(self._rows) >= self.at_once or time.monotonic() - self._since >= self.seconds
        if due:
            self.flush()

    def onQueryTerminated(self, event: Any) -> None:
        if self._rows:
            self.flush()
        if str(event.runId) in self._active:
            self._active.discard(str(event.runId))
            self.over = not self._active

    def flush(self) -> None:
        """Append what is held back to the table."""
        with self._lock:
            rows, self._rows = self._rows, []
        self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def table(self) -> DataFrame:
        """All reports so far; waits for those that Spark has not delivered yet."""
        self.spark._jsc.sc().listenerBus().waitUntilEmpty(300_000)
        self.flush()
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.folder)


def _row(report: Any) -> tuple:
    report = json.loads(report.json) if hasattr(report, "json") else dict(report)
    source = (report.get("sources") or [{}])[0]

    rate = report.get("inputRowsPerSecond")
    return (
        report.get("batchId"),
        report.get("numInputRows"),
        None if rate is None else float(rate),
        (report.get("durationMs") or {}).get("triggerExecution"),
        text(source.get("startOffset")),
        text(source.get("endOffset")),
    )


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The last reports, as Spark keeps them in memory; ``ProgressLog`` keeps all."""
    return spark.createDataFrame([_row(p) for p in query.recentProgress], PROGRESS_SCHEMA)


def caught_up_without_data(progress: DataFrame) -> DataFrame:
    """Batches that read nothing although the source reports an end offset.

    The committed offset is then already at the end: usually a checkpoint that
    outlived a change of the start position.
    """
    return progress.where((F.col("records") == 0) & F.col("end_offset").isNotNull())


def await_with_progress(query: StreamingQuery, poll_seconds: int = 10) -> None:
    """Block until the query ends and log each newly finished batch."""
    waited, last_batch = 0, None
    while query.isActive:
        if query.awaitTermination(poll_seconds):
            return
        report = query.lastProgress
        batch = None if report is None else _row(report)
        if batch is None or batch[0] == last_batch:
            waited += poll_seconds
            level = logging.WARNING if waited >= STALL_SECONDS else logging.INFO
            LOG.log(level, "no new batch for %ds: %s", waited, query.status.get("message"))
            continue
        waited, last_batch = 0, batch[0]
        LOG.info("batch %s: %s records, %s/s, %s ms, offsets %s to %s", *batch)
        if batch[1] == 0 and batch[5] is not None:
            LOG.info("nothing read although the source has an end offset: already caught up")
