from __future__ import annotations

import json

import pytest
from conftest import record
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wardline.operators.decode import parse_messages
from wardline.operators.prepare import detections, traffic_counts
from wardline.operators.rules import evaluate
from wardline.operators.shipped_rules import shipped_rules
from wardline.schema import INCOMPLETE, RECORD_FIELDS, UNPARSEABLE, VERDICT_FIELDS
from wardline.sources.messages import MESSAGE_SCHEMA, file_stream
from wardline.streaming import job
from wardline.streaming.progress import LOG_SCHEMA, ProgressLog, caught_up_without_data, progress_table
from wardline.streaming.store import Store


def good(i: int) -> str:
    attack = {"label": "ddos", "count": 300, "serror_rate": 0.9, "dst_bytes": 0} if i % 10 == 0 else {"count": 20}
    return json.dumps(record(timestamp=1.7e9 + i, src_bytes=i, same_srv_rate=0.9, **attack))


BROKEN = ["not json at all", good(1)[:90], "", '{"duration": 1.0}', '{"label": "ddos"}', '{"flag": "SF"}']


def deliver(folder, name: str, messages: list[str]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(messages) + "\n")


class Live:
    def __init__(self, spark, tmp_path):
        self.spark, self.source = spark, tmp_path / "in"
        self.source.mkdir()
        self.store = Store(spark, str(tmp_path / "store"))
        self.checkpoint = str(tmp_path / "checkpoint")

    def run(self):
        stream = file_stream(self.spark, str(self.source), max_files=1)
        return job.run_available(stream, shipped_rules(), self.store, self.checkpoint)

    def totals(self):
        rows = self.store.counts().groupBy("label").agg(F.sum("record_count")).collect()
        return {r[0]: r[1] for r in rows}

    def stored(self):
        return sorted(r[0] for r in self.store.detections().select("src_bytes").collect())


@pytest.fixture
def live(spark, tmp_path):
    return Live(spark, tmp_path)


def test_malformed_messages_end_to_end_and_stream_equals_batch(spark, live):
    deliver(live.source, "a", [good(i) for i in range(200)] + BROKEN[:3])
    deliver(live.source, "b", [good(i) for i in range(200, 400)] + BROKEN[3:])
    query = live.run()
    assert live.totals() == {"normal": 360, "ddos": 40, UNPARSEABLE: 3, INCOMPLETE: 3}
    assert live.stored() == list(range(0, 400, 10))

    batch = evaluate(parse_messages(spark.read.schema(MESSAGE_SCHEMA).text(str(live.source))), shipped_rules())
    columns = [*RECORD_FIELDS, *VERDICT_FIELDS]
    want = detections(batch, F.lit(0), F.current_timestamp()).select(*columns)
    have = live.store.detections().select(*columns)
    assert have.exceptAll(want).count() == want.exceptAll(have).count() == 0
    counted = traffic_counts(batch, F.lit(0), F.current_timestamp())
    assert live.totals() == {r["label"]: r["record_count"] for r in counted.collect()}

    progress = progress_table(spark, query)
    read = progress.where("records > 0").agg(F.count(F.lit(1)), F.sum("records")).first()
    assert tuple(read) == (2, 406)
    assert {"batch_ms", "end_offset"} <= set(progress.columns)


def test_resume_reads_only_what_is_new(live):
    deliver(live.source, "a", [good(i) for i in range(50)])
    live.run()
    assert live.stored() == [0, 10, 20, 30, 40]
    live.run()
    assert live.totals() == {"normal": 45, "ddos": 5}
    deliver(live.source, "b", [good(i) for i in range(50, 60)])
    live.run()
    assert live.totals() == {"normal": 54, "ddos": 6}
    assert live.store.counts().select("run_id").distinct().count() == 1


def test_crash_between_the_writes_is_replayed_once(live, monkeypatch):
    deliver(live.source, "a", [good(i) for i in range(30)])
    original = Store.write_batch

    def dies_after_writing(self, *args, **kwargs):
        original(self, *args, **kwargs)
        raise RuntimeError("killed before the commit")

    monkeypatch.setattr(Store, "write_batch", dies_after_writing)
    with pytest.raises(StreamingQueryException):
        live.run()
    monkeypatch.undo()
    live.run()
    assert live.totals() == {"normal": 27, "ddos": 3}
    assert live.stored() == [0, 10, 20]


def test_a_wiped_checkpoint_starts_a_new_run(spark, live, tmp_path):
    deliver(live.source, "a", [good(i) for i in range(20)])
    live.run()
    live.checkpoint = str(tmp_path / "fresh")
    live.run()
    assert live.store.counts().select("run_id").distinct().count() == 2
    assert live.totals() == {"normal": 36, "ddos": 4}


def test_reset_first_empties_the_tables(live):
    deliver(live.source, "a", [good(i) for i in range(20)])
    live.run()
    stream = file_stream(live.spark, str(live.source))
    query = job.start_detection(
        stream, shipped_rules(), live.store, live.checkpoint, trigger=None, reset_first=True
    )
    query.awaitTermination()
    assert live.totals() == {}


def test_processing_time_trigger_and_watching(live, caplog):
    from wardline.streaming import progress as watching

    deliver(live.source, "a", [good(i) for i in range(20)])
    query = job.start_detection(
        file_stream(live.spark, str(live.source)), shipped_rules(), live.store, live.checkpoint,
        trigger="200 milliseconds",
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    with caplog.at_level("INFO", logger="wardline"):
        watching.await_with_progress(query, poll_seconds=1)
    assert live.totals() == {"normal": 18, "ddos": 2}


def test_every_batch_and_source_is_logged(spark, live):
    """More batches than Spark remembers, from two sources."""
    other = live.source.parent / "other"
    for i in range(120):
        deliver(live.source, f"f{i:03}", [good(i)])
    deliver(other, "o", [good(500)])
    log = ProgressLog(spark, str(live.source.parent / "progress"), at_once=50)
    spark.streams.addListener(log)
    try:
        both = file_stream(spark, str(live.source), max_files=1).union(file_stream(spark, str(other), max_files=1))
        run = both.writeStream.format("noop").trigger(availableNow=True)
        query = run.option("checkpointLocation", str(live.source.parent / "c")).start()
        query.awaitTermination()
        table = log.table()
    finally:
        spark.streams.removeListener(log)
    own = table.where(F.col("query_run") == str(query.runId))
    assert own.select("batch_id").distinct().count() >= 120 and {r["source"] for r in own.select("source").collect()} == {0, 1}
    assert own.agg(F.sum("records")).first()[0] == 121


def test_reports_and_totals_outlive_the_query(spark, live):
    """Two runs on one checkpoint; nobody asks the log for its table."""
    for name in "ab":
        deliver(live.source, name, [good(i) for i in range(20)] + BROKEN)
        query = live.run()
        spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        kept = spark.read.schema(LOG_SCHEMA).parquet(job.progress_folder(live.store))
        assert kept.where(F.col("query_run") == str(query.runId)).agg(F.sum("records")).first()[0] == 26
    assert kept.agg(F.sum("records")).first()[0] == 52
    run = job.run_id_of(spark, live.checkpoint)
    batches = live.store.batches(run)
    assert batches.agg(F.sum("messages"), F.sum("valid")).first()[:] == (52, 40) and batches.where("batch_ms <= 0").count() == 0
    log = job.BatchLog.resumed(live.store, run)
    assert (log.unparseable + log.incomplete, log.idle) == (12, 0)
    assert job.run_id_of(spark, live.checkpoint) == run


def test_batch_log_has_totals_and_idle_notices(caplog):
    from wardline.streaming.job import BatchLog
    from wardline.streaming.store import BatchTotals

    log = BatchLog()
    with caplog.at_level("INFO", logger="wardline"):
        log.note(0, BatchTotals(8, 1, 1))
        for batch in range(1, 62):
            log.note(batch, BatchTotals(0, 0, 0))
        log.note(62, BatchTotals(3, 0, 1))
        log.note(63, BatchTotals(0, 0, 0))
    lines = [r.message for r in caplog.records]
    assert "(20.00%); so far 1 unparseable, 1 incomplete" in lines[0]
    assert [line.split(",")[1].split()[0] for line in lines[1:4]] == ["1", "30", "60"]
    assert "(25.00%); so far 1 unparseable, 2 incomplete" in lines[4] and " 1 idle" in lines[5] and len(lines) == 6


def test_zero_row_diagnosis(spark):
    rows = [(0, 5, 1.0, 10, None, "{}"), (1, 0, 0.0, 3, "{}", "{}"), (2, 0, 0.0, 3, None, None)]
    from wardline.streaming.progress import PROGRESS_SCHEMA

    table = spark.createDataFrame(rows, PROGRESS_SCHEMA)
    assert [r["batch_id"] for r in caught_up_without_data(table).collect()] == [1]


class FakeQuery:
    """A query that is idle, reads one batch, then ends."""

    def __init__(self, reports):
        self.reports, self.status = list(reports), {"message": "waiting"}

    isActive = True

    def awaitTermination(self, _):
        return not self.reports

    @property
    def lastProgress(self):
        return self.reports.pop(0)


def test_watcher_reports_batches_stalls_and_idle_sources(caplog):
    from wardline.streaming import progress as watching

    idle = {"batchId": 1, "numInputRows": 0, "sources": [{"endOffset": {"x": 1}}]}
    with caplog.at_level("INFO", logger="wardline"):
        watching.await_with_progress(FakeQuery([None] * 7 + [idle]), poll_seconds=10)
    stalls = [r for r in caplog.records if r.levelname == "WARNING"]
    assert len(stalls) == 2 and "70s" in stalls[-1].message
    assert "already caught up" in caplog.records[-1].message
