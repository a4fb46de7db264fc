from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from conftest import record
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wardline.operators import monitoring, prepare, scoring
from wardline.operators.rules import evaluate, parse_rules
from wardline.schema import INCOMPLETE, RECORD_FIELDS, RECORD_SCHEMA, VALID, VERDICT_FIELDS, detections_schema
from wardline.streaming import store as store_module
from wardline.streaming.commits import CommitLog, State
from wardline.streaming.job import BatchLog
from wardline.streaming.store import Store

RULES = parse_rules([
    {"rule_id": "flood", "attack_type": "ddos", "severity": "high",
     "conditions": [{"field": "count", "op": ">=", "value": 100}]},
])
NOW = datetime(2024, 1, 1, 0, 0, 10, tzinfo=timezone.utc)
EMITTED = NOW.timestamp() - 0.5


def judged(spark, *rows):
    data = [tuple(record(timestamp=EMITTED, **r)[n] for n in RECORD_FIELDS) for r in rows]
    return evaluate(spark.createDataFrame(data, RECORD_SCHEMA), RULES)


@pytest.fixture
def three(spark):
    """A caught attack, quiet normal traffic, a false alarm."""
    return judged(spark, {"label": "ddos", "count": 300}, {"count": 1}, {"count": 150})


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    s.ensure_tables()
    return s


def contents(store):
    det = sorted(tuple(r) for r in store.detections().select("run_id", "batch_id", "label", "count").collect())
    cnt = sorted(tuple(r) for r in store.counts().select("run_id", "batch_id", "label", "record_count").collect())
    return det, cnt


def test_preparation_keeps_two_of_three_and_counts_all(three):
    kept = prepare.detections(three, F.lit(1), F.lit(NOW)).collect()
    assert sorted((r["label"], r["is_detection"], r["batch_id"]) for r in kept) == [
        ("ddos", True, 1), ("normal", True, 1)]
    counted = prepare.traffic_counts(three, F.lit(1), F.lit(NOW)).collect()
    assert {r["label"]: r["record_count"] for r in counted} == {"ddos": 1, "normal": 2}


def test_malformed_rows_are_counted_but_not_stored(three):
    marked = three.withColumn("_status", F.when(F.col("count") == 300, "__malformed_incomplete__").otherwise(VALID))
    marked = marked.withColumn("_count_label", F.when(F.col("_status") == VALID, F.col("label")).otherwise(F.col("_status")))
    assert [r["label"] for r in prepare.detections(marked, F.lit(1), F.lit(NOW)).collect()] == ["normal"]
    counted = prepare.traffic_counts(marked, F.lit(1), F.lit(NOW)).collect()
    assert {r["label"]: r["record_count"] for r in counted} == {"__malformed_incomplete__": 1, "normal": 2}


def test_round_trip_keeps_arrays_booleans_and_stamps(store, three):
    totals = store.write_batch(three, 3, now=NOW)
    assert (totals.messages, totals.valid, totals.unparseable, totals.incomplete) == (3, 3, 0, 0)
    back = store.detections()
    assert [(f.name, f.dataType) for f in back.schema.fields][:-1] == [
        (f.name, f.dataType) for f in detections_schema().fields]
    rows = {r["label"]: r for r in back.collect()}
    assert rows["ddos"]["matched_rule_ids"] == ["flood"] and rows["ddos"]["matched_attack_types"] == ["ddos"]
    assert rows["ddos"]["is_detection"] is True and rows["ddos"]["max_severity"] == "high"
    assert {r["batch_id"] for r in rows.values()} == {3}
    assert all(abs(r["latency_seconds"] - 0.5) < 1e-6 for r in rows.values())
    assert len({r["processed_at"] for r in rows.values()}) == 1
    should = prepare.detections(three, F.lit(3), F.lit(NOW))
    trip = {r["label"]: tuple(r)[1:] for r in store.round_trip("main", should).collect()}
    assert trip == {"ddos": (1, 1, True, True), "normal": (1, 1, True, True)}
    other = should.withColumn("matched_rule_ids", F.array(F.lit("flood"), F.lit("more")))
    assert not any(r["same_values"] for r in store.round_trip("main", other).collect())
    assert {r["read_back"] for r in store.round_trip("none", should).collect()} == {0}


def test_rewriting_a_batch_replaces_it(spark, store, three):
    store.write_batch(three, 0)
    before = contents(store)
    store.write_batch(three, 0)
    assert contents(store) == before
    store.write_batch(judged(spark, {"count": 1}), 0)
    assert contents(store) == ([], [("main", 0, "normal", 1)])


def test_runs_do_not_overwrite_each_other(store, three):
    store.write_batch(three, 0, run_id="first")
    store.write_batch(three, 0, run_id="second")
    assert len(contents(store)[0]) == 4


def test_a_half_written_batch_is_not_read(spark, store, three, monkeypatch):
    store.write_batch(three, 0)
    before = contents(store)

    def crash(*_):
        raise RuntimeError("lost between the two writes")

    monkeypatch.setattr("wardline.streaming.store.traffic_counts", crash)
    with pytest.raises(RuntimeError):
        store.write_batch(three, 1)
    assert contents(store) == before
    monkeypatch.undo()
    store.write_batch(three, 1)
    assert len(contents(store)[0]) == 4


@pytest.mark.parametrize("stage", ["detections", "traffic_counts"])
def test_a_crash_inside_a_replay_shows_no_half_batch(store, three, monkeypatch, stage):
    store.write_batch(three, 0)
    store.write_batch(three, 1, now=NOW)
    whole = contents(store)

    def crash(*_):
        raise RuntimeError("lost during the replay")

    monkeypatch.setattr(f"wardline.streaming.store.{stage}", crash)
    with pytest.raises(RuntimeError):
        store.write_batch(three, 1)  # on another day than before
    assert contents(store) == whole  # what the batch held before, until the replay is committed
    assert scoring.integrity(store.detections(), store.counts()).where("NOT passed").count() == 0
    monkeypatch.undo()
    store.write_batch(three, 1)
    assert contents(store) == whole


def test_two_runs_are_scored_apart_and_together(spark, store, three):
    store.write_batch(three, 0, "a")
    store.write_batch(three, 1, "a")
    store.write_batch(judged(spark, {"label": "ddos", "count": 1}), 0, "b")
    assert scoring.batch_window(store.counts()).first()["batches"] == 3
    assert scoring.batch_window(store.counts(run_id="a")).first()["batches"] == 2
    health = monitoring.batch_health(store.counts())
    assert sorted((r["run_id"], r["batch_id"], r["messages"]) for r in health.collect()) == [("a", 0, 3), ("a", 1, 3), ("b", 0, 1)]
    assert monitoring.malformed_running(health).count() == 3
    recall = {r: scoring.overall_metrics(store.detections(run_id=r), store.counts(run_id=r)).first()["recall"] for r in "ab"}
    assert recall == {"a": 1.0, "b": 0.0}


def test_a_recent_window_opens_recent_days_only(store, three):
    for day in (1, 2, 3):
        store.write_batch(three, day, now=NOW.replace(day=day))
    recent = store.detections(since=NOW.replace(day=3))
    assert {r["batch_id"] for r in recent.collect()} == {3}
    assert len({f.rpartition("/")[0] for f in recent.inputFiles()}) == 1 and "/2024-01-03/" in recent.inputFiles()[0]


def filled(spark, root, zone="UTC"):
    """Three batches of one UTC day and one of the next, in two runs."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", zone)
    store = Store(own, str(root))
    store.ensure_tables()
    rows = judged(own, {"label": "ddos", "count": 300}, {"count": 1}, {"count": 150})
    for batch, hour in enumerate((1, 12, 20)):
        store.write_batch(rows, batch, "a", now=NOW.replace(hour=hour))
    store.write_batch(rows, 0, "b", now=NOW.replace(day=2, hour=3))
    return store, rows


def files_of(frame):
    return {f.rpartition("/")[2] for f in frame.inputFiles()}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh", "America/Los_Angeles"])
def test_compaction_keeps_the_rows(spark, tmp_path, zone):
    store, rows = filled(spark, tmp_path, zone)
    before, batches = contents(store), sorted(map(tuple, store.batches().collect()))
    for _ in range(2):
        store.compact(NOW.date())
        assert contents(store) == before and sorted(map(tuple, store.batches().collect())) == batches
    assert [k for k in store.log.read().batches] == [("b", 0)] and len(store.log.read().merges) == 1
    assert store.detections(since=NOW.replace(day=2)).count() == 2
    assert store.detections(run_id="a").count() == 6
    store.write_batch(rows, 9, "a", now=NOW.replace(hour=23))
    store.compact(NOW.date())  # again, with a batch more
    assert len(contents(store)[0]) == len(before[0]) + 2 and list(store.log.read().batches) == [("b", 0)]
    store.reset()
    assert contents(store) == ([], []) and store.batches().count() == 0


def test_deleting_and_replaying_batches_of_a_compacted_day(spark, tmp_path):
    store, rows = filled(spark, tmp_path)
    store.compact(NOW.date())
    before = contents(store)
    store.write_batch(rows, 1, "a")  # a replay, days later
    assert contents(store) == before
    store.write_batch(judged(store.spark, {"count": 1}), 1, "a", now=NOW)
    assert contents(store)[0] == [r for r in before[0] if r[:2] != ("a", 1)]
    assert [r for r in contents(store)[1] if r[:2] == ("a", 1)] == [("a", 1, "normal", 1)]
    store.delete_batch(2, "a")
    store.delete_batch(0, "b")  # of an open day
    assert {r[:2] for r in contents(store)[1]} == {("a", 0), ("a", 1)}
    assert {r.batch_id for r in store.batches().collect()} == {0, 1}
    now = contents(store)
    store.compact(NOW.date())
    assert contents(store) == now and not store.log.read().batches
    assert all(not m["gone"] for m in store.log.read().merges.values())


@pytest.mark.parametrize("crash_at", range(6))
def test_a_compaction_lost_at_any_step_changes_nothing(spark, tmp_path, monkeypatch, crash_at):
    store, _ = filled(spark, tmp_path)
    before, seen = contents(store), []

    def counted(name, real):
        def step(*args, **kwargs):
            assert contents(store) == before  # a reader between any two steps
            if len(seen) == crash_at:
                raise RuntimeError("lost")
            seen.append(name)
            return real(*args, **kwargs)
        return step

    with monkeypatch.context() as patched:
        patched.setattr("wardline.streaming.store._ranges", counted("write", store_module._ranges))
        patched.setattr("wardline.streaming.store._piece", counted("count", store_module._piece))
        patched.setattr("wardline.streaming.commits.files.create", counted("commit", store_module.files.create))
        with pytest.raises(RuntimeError):
            store.compact(NOW.date())
    assert contents(store) == before and len(store.log.read().batches) == 4
    store.compact(NOW.date())
    assert contents(store) == before and len(store.log.read().batches) == 1


def test_readers_keep_to_their_commit(spark, tmp_path):
    store, rows = filled(spark, tmp_path)
    pinned, before = store.snapshot(), contents(store)
    store.compact(NOW.date())
    store.delete_batch(0, "a")
    store.write_batch(rows, 0, "b", now=NOW)
    rows_of = lambda s: sorted(tuple(r) for r in s.detections().select("run_id", "batch_id", "label", "count").collect())
    assert rows_of(pinned) == before[0] and len(rows_of(store.snapshot())) == len(before[0]) - 2
    assert store.vacuum() == 0  # everything is younger than a day
    assert store.vacuum(timedelta(0)) > 0
    assert len(contents(store)[0]) == len(before[0]) - 2
    with pytest.raises(Exception, match="(?i)not.*exist"):
        rows_of(pinned)


@pytest.mark.parametrize("meanwhile", ["replay", "delete", "new", "compact"])
def test_what_happens_during_a_compaction_holds(spark, tmp_path, monkeypatch, meanwhile):
    store, rows = filled(spark, tmp_path)
    other, real = Store(store.spark, store.root), CommitLog.commit
    quiet = judged(store.spark, {"count": 1})
    acts = {
        "replay": lambda: other.write_batch(quiet, 1, "a", now=NOW),
        "delete": lambda: other.delete_batch(1, "a"),
        "new": lambda: other.write_batch(rows, 7, "a", now=NOW),
        "compact": lambda: other.compact(NOW.date()),
    }

    def late(log, change):
        if log is store.log:
            monkeypatch.setattr(CommitLog, "commit", real)
            acts[meanwhile]()
        return real(log, change)

    monkeypatch.setattr(CommitLog, "commit", late)
    if meanwhile == "compact":
        store.compact(NOW.date())  # nothing of what it read is there any more: its own merge holds no row
        assert len(contents(store)[0]) == 8
    else:
        store.compact(NOW.date())
    expected = {"replay": 6, "delete": 6, "new": 10, "compact": 8}[meanwhile]
    assert len(contents(store)[0]) == expected
    store.compact(NOW.date())
    assert len(contents(store)[0]) == expected


def test_two_writers_never_share_a_number(spark, tmp_path):
    one, two = (CommitLog(spark, str(tmp_path)) for _ in range(2))
    for turn in range(120):
        (one, two)[turn % 2].commit(lambda s, t=turn: {"put": [{"run": "a", "batch": t, "pieces": {}}]})
    fresh = CommitLog(spark, str(tmp_path)).read()
    assert fresh.version == 119 and len(fresh.batches) == 120 and State.from_json(fresh.to_json()) == fresh
    one.shorten()
    assert CommitLog(spark, str(tmp_path)).read() == fresh == two.read()
    assert one.commit(lambda s: None) == fresh


def test_labels_and_times_choose_files(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.ensure_tables()
    for batch in range(6):
        at = NOW + timedelta(minutes=batch)
        rows = judged(spark, {"label": "ddos", "count": 300}, {"label": "scan", "count": 1}, {"count": 150})
        store.write_batch(rows.withColumn("timestamp", F.lit(at.timestamp())), batch, now=at)
    third = NOW.timestamp() + 120
    recent = store.detections(spans=[(third - 5, third + 5)])
    assert recent.count() == 3 and len({f.rpartition("/")[0] for f in recent.inputFiles()}) == 1
    assert store.detections(labels=["absent", "zebra"]).inputFiles() == []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.compact(NOW.date())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    everything, one = files_of(store.detections()), files_of(store.detections(labels=["ddos"]))
    assert store.detections(labels=["ddos"]).count() == 6 and 0 < len(one) < len(everything)
    both = store.detections(labels=["ddos"], spans=[(third, third)])
    assert both.count() == 1 and len(files_of(both)) <= len(one)


def test_drill_down_opens_the_alerts_files_only(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    store.ensure_tables()
    for batch in range(5):
        at = NOW + timedelta(minutes=batch)
        rows = judged(spark, {"label": "ddos", "count": 300}, {"count": 150 if batch == 3 else 1})
        store.write_batch(rows.withColumn("timestamp", F.lit(at.timestamp())), batch, now=at)
    false_alarms = monitoring.only_verdict(monitoring.alerts(store.detections()))
    near = store.snapshot().around(false_alarms)
    want = monitoring.drill_down(monitoring.raw_rows(store.detections()), false_alarms)
    assert sorted(map(tuple, monitoring.raw_rows(near).collect())) == sorted(map(tuple, want.collect())) and near.count() == 2
    assert len({f.rpartition("/")[0] for f in near.inputFiles() if "/detections/" in f}) <= 5
    opened = near._jdf.queryExecution().optimizedPlan().toString()
    assert "timestamp" in opened
    plan = store.snapshot().detections(spans=[(NOW.timestamp() + 180, NOW.timestamp() + 180)])
    assert len({f.rpartition("/")[0] for f in plan.inputFiles()}) == 1
    monkeypatch.setattr("wardline.streaming.store.RANGES", 0)
    assert sorted(map(tuple, monitoring.raw_rows(store.snapshot().around(false_alarms)).collect())) == sorted(map(tuple, want.collect()))
    assert store.snapshot().around(false_alarms.limit(0)).count() == 0


def test_columns_may_be_added_and_nothing_else(spark, tmp_path, three):
    store = Store(spark, str(tmp_path))
    store.ensure_tables()
    store.write_batch(three, 0)
    wider = StructType([*RECORD_SCHEMA.fields, StructField("sensor", StringType())])
    grown = Store(spark, str(tmp_path), wider)
    grown.ensure_tables()
    grown.write_batch(three.withColumn("sensor", F.lit("s1")), 1)
    for reader in (store, grown):
        assert sorted((r.batch_id, r.sensor) for r in reader.detections().collect()) == [(0, None)] * 2 + [(1, "s1")] * 2
    grown.compact(datetime.now(timezone.utc).date())
    assert grown.detections().where("sensor = 's1'").count() == 2
    with pytest.raises(ValueError, match="sensor is stored and would be lost"):
        store.ensure_tables()
    other = StructType([StructField(f.name, StringType() if f.name == "count" else f.dataType) for f in wider.fields])
    with pytest.raises(ValueError, match="count is stored as int, not string"):
        Store(spark, str(tmp_path), other).ensure_tables()
    strict = StructType([*wider.fields, StructField("must", StringType(), False)])
    with pytest.raises(ValueError, match="nullable"):
        Store(spark, str(tmp_path), strict).ensure_tables()


def test_a_batch_log_goes_on_where_the_run_stopped(spark, tmp_path, three, caplog):
    store = Store(spark, str(tmp_path))
    store.ensure_tables()
    assert vars(BatchLog.resumed(store, "a")) == {"idle_every": 30, "unparseable": 0, "incomplete": 0, "idle": 0}
    broken = three.withColumn("_status", F.lit(INCOMPLETE)).withColumn("_count_label", F.lit(INCOMPLETE))
    first = BatchLog.resumed(store, "a")
    for batch, rows in enumerate([broken, three, broken, three.where("false"), three.where("false")]):
        first.note(batch, store.write_batch(rows, batch, "a"))
    store.compact(datetime.now(timezone.utc).date())
    second = BatchLog.resumed(store, "a")
    assert vars(second) == vars(first) and (second.incomplete, second.idle) == (6, 2)
    assert vars(BatchLog.resumed(store, "b"))["incomplete"] == 0


def test_delete_batch(store, three):
    for batch in (0, 1, -1):
        store.write_batch(three, batch)
    store.delete_batch(-1)
    store.delete_batch(1)
    det, cnt = contents(store)
    assert {r[1] for r in det} == {r[1] for r in cnt} == {0}


def test_reset_keeps_the_tables(store, three):
    store.write_batch(three, 0)
    store.reset()
    assert contents(store) == ([], [])
    store.write_batch(three, 0)
    assert len(contents(store)[0]) == 2


def test_ensure_tables_keeps_rows(store, three):
    store.write_batch(three, 0)
    store.ensure_tables()
    assert len(contents(store)[0]) == 2


def test_an_empty_batch_stores_nothing(store, three):
    totals = store.write_batch(three.where("false"), 0)
    assert totals.messages == 0 and contents(store) == ([], [])


def test_bulk_loads_need_no_cache(store, three):
    store.write_batch(three, 0)
    with_cache = contents(store)
    store.write_batch(three, 0, cached=False)
    assert contents(store) == with_cache


def test_cache_is_released(spark, store, three):
    store.write_batch(three, 0)
    assert not three.is_cached


def test_stored_files_are_clustered_by_label(spark, store):
    rows = [{"label": name, "count": 200} for name in ("a", "b", "c")] * 40
    store.write_batch(judged(spark, *rows), 0)
    files = store.detections().select("label", F.input_file_name().alias("f"))
    spans = files.groupBy("f").agg(F.count_distinct("label").alias("n")).collect()
    assert sum(r["n"] for r in spans) == 3


def test_verdict_columns_are_stored_in_order():
    assert detections_schema().fieldNames()[43:47] == VERDICT_FIELDS
