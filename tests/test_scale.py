"""What keeps the queries in proportion to their input."""

from __future__ import annotations

import compare
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from wardline.plans import catalog, staging
from wardline.plans.oracle import ORACLE


@pytest.fixture(autouse=True)
def staged_anew():
    staging.forget()
    yield
    staging.forget()


def test_all_cores_build_messages_and_only_events_are_dealt_out(spark, monkeypatch):
    built, make = [], catalog.adapters.message_view
    monkeypatch.setattr(catalog.adapters, "message_view", lambda events: built.append(events) or make(events))
    views = catalog.Views(spark, DATA)
    files = views.messages.inputFiles()
    assert [f.rdd.getNumPartitions() for f in built] == [spark.sparkContext.defaultParallelism]
    assert len(files) == spark.sparkContext.defaultParallelism
    assert all(".zstd." in name for name in files)
    assert views.messages.count() == views.table("events").count()


@pytest.mark.parametrize("backlog", [0, 1000, 100_000, 600_000, 6_000_000, 36_000_000])
def test_a_backlog_is_caught_up_in_few_batches_that_no_core_is_overrun_by(backlog):
    for cores in (1, 4, 12):
        bounds = catalog.batch_bounds(backlog, cores)
        least = catalog.BATCH_FILES * catalog.FILE_MESSAGES
        most = max(least, cores * catalog.CORE_MESSAGES + bounds.files)
        assert least <= bounds.ceiling <= most
        assert backlog <= bounds.ceiling * catalog.CATCH_UP_BATCHES or bounds.ceiling >= cores * catalog.CORE_MESSAGES


def test_longer_backlogs_do_not_take_more_batches(spark, monkeypatch):
    """Bounds of a thousandth: with the fixed ones, the 1,000 messages would take 100 batches."""
    monkeypatch.setattr(catalog, "BATCH_FILES", 1)
    monkeypatch.setattr(catalog, "FILE_MESSAGES", 10)
    views = catalog.Views(spark, DATA)
    source, store, checkpoint = catalog._live(views)
    catalog._deliver_and_drain(views, views.messages, source, store, checkpoint)
    batches = [r["messages"] for r in store.batches().collect()]
    assert sum(batches) == 1000 and len(batches) <= catalog.CATCH_UP_BATCHES + spark.sparkContext.defaultParallelism


def test_progress_counts_messages_once_however_often_they_are_evaluated(spark, monkeypatch):
    """Executors that evaluate the same rows - three jobs at a time, a lost one - add to Spark's reports."""
    write = catalog.Store.write_batch
    monkeypatch.setattr(catalog.Store, "write_batch", lambda self, *given: write(self, *given, cached=False))
    frame = catalog.registered()["stream_progress"](spark, DATA)
    assert compare.differences(frame, compare.duck(DATA), ORACLE["stream_progress"]) == []


def test_a_batch_reads_its_messages_once_and_caches_quiet_rows_as_a_word(spark, monkeypatch, tmp_path):
    views, kept = catalog.Views(spark, DATA), []
    monkeypatch.setattr(
        "wardline.streaming.store.rollups.alert_parts",
        lambda rows, make=catalog.rollups.alert_parts: kept.append(rows._jdf.queryExecution().optimizedPlan().toString()) or make(rows),
    )
    store, read = catalog.Store(spark, str(tmp_path / "store")), spark.sparkContext.accumulator(0)

    def counting(value):
        read.add(1)
        return value

    once = F.udf(counting)
    rows = views.judged.drop("event_id", "batch_id", "processed_at").withColumn("flag", once("flag"))
    store.write_batch(rows, 0)
    assert read.value == 1000
    assert "InMemoryRelation [_count_label" in kept[0]
