"""Roll-ups and closing windows against the batch queries over all rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import record
from pyspark.sql import functions as F

from wardline.functions.expressions import minute_of
from wardline.operators import monitoring, rollups
from wardline.operators.rules import evaluate, parse_rules
from wardline.schema import RECORD_FIELDS, RECORD_SCHEMA, detections_schema
from wardline.streaming import windows
from wardline.streaming.store import Store

RULES = parse_rules([
    {"rule_id": "flood", "attack_type": "ddos", "severity": "high", "conditions": [{"field": "count", "op": ">=", "value": 100}]},
])
START = datetime(2024, 1, 1, 0, 0, tzinfo=timezone.utc)


def judged(spark, seed: int, at: datetime, n: int = 300):
    """Records of the ten minutes before ``at``, one in fifty half an hour late."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        late = 1800 if i % 50 == 7 else 0
        rows.append(record(
            timestamp=at.timestamp() - rng.random() * 600 - late, label=rng.choice(["ddos", "scan", "normal"]),
            count=rng.choice([1, 120, 300]), service=rng.choice(["http", "dns", "ssh", None]),
        ))
    return evaluate(spark.createDataFrame([tuple(r[f] for f in RECORD_FIELDS) for r in rows], RECORD_SCHEMA), RULES)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    out = Store(spark, str(tmp_path_factory.mktemp("rollups")))
    out.ensure_tables()
    for batch in range(6):
        at = START + timedelta(minutes=5 * (batch + 1))
        out.write_batch(judged(spark, batch, at), batch, "ab"[batch % 2], now=at)
    return out


def bag(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


def test_alerts_from_parts_equal_alerts_from_rows(store):
    for run in (None, "a"):
        parts, rows = store.snapshot().alerts(run), monitoring.alerts(store.detections(run))
        assert parts.columns == rows.columns and bag(parts) == bag(rows)


def test_they_still_do_when_batches_go_and_days_are_merged(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.ensure_tables()
    for batch in range(4):
        store.write_batch(judged(spark, batch, START + timedelta(minutes=batch)), batch, now=START)
    store.compact(START.date())
    store.delete_batch(1)
    store.write_batch(judged(spark, 9, START), 2, now=START)
    assert bag(store.snapshot().alerts()) == bag(monitoring.alerts(store.detections()))


def test_parts_are_a_fraction_of_the_rows(spark, tmp_path):
    """Few alerts of many records, as in an attack."""
    store = Store(spark, str(tmp_path))
    store.ensure_tables()
    rows = judged(spark, 1, START, 40)
    store.write_batch(rows.withColumn("timestamp", F.floor(F.col("timestamp") / 600) * 600.0).crossJoin(spark.range(2000)).drop("id"), 0)
    size = lambda frame: sum(len(open(f.removeprefix("file://"), "rb").read()) for f in frame.inputFiles())  # noqa: E731, SIM115
    snapshot = store.snapshot()
    assert bag(snapshot.alerts()) == bag(monitoring.alerts(snapshot.detections()))
    assert snapshot.alert_parts().count() < snapshot.detections().count() / 1000
    assert size(snapshot.alert_parts()) < size(snapshot.detections())


def ranks_are_near(found, rows, clock: str):
    """Every quantile's rank among the minute's rows, as the sketch promises."""
    values: dict = {}
    for minute, latency in rows.select(minute_of(F.col(clock)), "latency_seconds").collect():
        values.setdefault(minute, []).append(latency)
    got = {r["minute"]: r for r in found.collect()}
    assert set(got) == set(values)
    for minute, own in values.items():
        assert got[minute]["max_s"] == round(max(own), 2)
        for name, p in rollups.LATENCY_QUANTILES.items():
            low = sum(v < got[minute][name] - 0.005 for v in own) / len(own)
            high = sum(v <= got[minute][name] + 0.005 for v in own) / len(own)
            assert low - rollups.RANK_ERROR <= p <= high + rollups.RANK_ERROR


def test_latency_from_sketches(spark, store):
    ranks_are_near(store.snapshot().latency_over_time(), store.detections(), "processed_at")
    assert store.snapshot().latency_over_time(since=START + timedelta(minutes=29)).count() == 1


def test_merged_sketches_keep_their_error(spark):
    """A hundred sketches of one minute, and of a hot value beside a long tail."""
    rng = random.Random(4)
    values = [(i % 100, 3.0 if i % 3 == 0 else rng.expovariate(1.0)) for i in range(60_000)]
    rows = spark.createDataFrame(values, "batch_id long, latency_seconds double").withColumn("processed_at", F.lit(START))
    parts = rows.groupBy("batch_id", F.col("processed_at").alias("batch_time")).agg(
        F.count("*").alias("latency_n"), F.max("latency_seconds").alias("latency_max"),
        F.kll_sketch_agg_double("latency_seconds", rollups.SKETCH).alias("latency_sketch"),
    )
    ranks_are_near(rollups.latency_of(parts), rows, "processed_at")
    assert parts.agg(F.max(F.length("latency_sketch"))).first()[0] < 8000  # whatever the rows of a minute


class Live:
    """Stored rows that arrive in files, and the windows that a stream closes over them."""

    def __init__(self, spark, tmp_path, closing, schema):
        self.spark, self.root, self.closing, self.schema = spark, tmp_path, closing, schema
        self.arrived = 0

    def arrive(self, batches):
        for rows in batches:
            rows.coalesce(1).write.mode("append").parquet(str(self.root / "in"))
            self.arrived += 1

    def frame(self, delay):
        stream = self.spark.readStream.schema(detections_schema()).option("maxFilesPerTrigger", 1)
        return self.closing(stream.parquet(str(self.root / "in")), delay)

    def run(self, delay="40 minutes"):
        frame = self.frame(delay)
        query = windows.start_closing(frame, str(self.root / "out"), str(self.root / "checkpoint"))
        query.awaitTermination()
        return query, self.spark.read.schema(self.schema).parquet(str(self.root / "out"))

    def rows(self):
        return self.spark.read.schema(detections_schema()).parquet(str(self.root / "in"))


def arriving(store):
    return [store.detections().where(F.col("batch_id") == i).drop("run_id") for i in range(6)]


def later(spark, hours: int):
    """A quiet row, long after everything else."""
    from wardline.operators.prepare import detections

    at = START + timedelta(hours=hours)
    one = judged(spark, 5, at, 30).where("label = 'ddos'").limit(1)
    return detections(one.withColumn("timestamp", F.lit(at.timestamp())), F.lit(99), F.lit(at))


def test_closing_alerts_equal_alerts(spark, store, tmp_path):
    live, batches = Live(spark, tmp_path, windows.closing_alerts, windows.CLOSED_SCHEMA), arriving(store)
    whole = lambda closed, open_rows: bag(rollups.alerts_of(closed).unionByName(monitoring.alerts(open_rows)))
    for part in (batches[:3], [*batches[3:], later(spark, 1)], [later(spark, 5)]):  # the stream starts anew each time
        live.arrive(part)
        query, closed = live.run()
        edge = windows.horizon(query)
        open_rows = live.rows().where(windows.still_open(F.timestamp_seconds(F.floor(F.col("timestamp") / 60) * 60), edge))
        assert whole(closed, open_rows) == bag(monitoring.alerts(live.rows()))
        assert windows.dropped(query) == 0
    assert closed.count() > 50 and open_rows.count() == 1
    assert closed.groupBy(*monitoring.ALERT_KEYS).count().where("count > 1").count() == 0  # each window once


def test_rows_beyond_the_delay_are_counted(spark, store, tmp_path):
    live = Live(spark, tmp_path, windows.closing_alerts, windows.CLOSED_SCHEMA)
    live.arrive([later(spark, 9)])
    live.run("1 minute")
    live.arrive(arriving(store)[:1])
    query, _ = live.run("1 minute")
    assert windows.dropped(query) > 0


def test_closing_latency_meets_its_error(spark, store, tmp_path):
    live = Live(spark, tmp_path, windows.closing_latency, windows.LATENCY_SCHEMA)
    live.arrive(arriving(store)[:4])
    live.run()
    live.arrive([*arriving(store)[4:], later(spark, 3), later(spark, 6)])
    _, closed = live.run()
    stored = live.rows().where("batch_id < 99")
    ranks_are_near(rollups.latency_of(closed.where(F.col("batch_time") < F.lit(START + timedelta(hours=2)))), stored, "processed_at")
    assert closed.count() == closed.select("batch_time").distinct().count()
