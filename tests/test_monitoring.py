from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wardline.functions.running import previous_value, running_totals
from wardline.operators import monitoring
from wardline.schema import INCOMPLETE, UNPARSEABLE

DET = (
    "timestamp double, label string, matched_attack_types array<string>, matched_rule_ids array<string>, "
    "max_severity string, is_detection boolean, service string, protocol_type string, src_bytes int, "
    "dst_bytes int, count int, latency_seconds double, processed_at timestamp"
)


def stored(ts, label, types, service="http", conns=1, latency=0.5, severity="high"):
    return (
        float(ts), label, types, [f"{t}_rule" for t in types], severity if types else None, bool(types),
        service, "tcp", 1, 2, conns, latency, datetime(2024, 1, 1, 0, 0, 30),
    )


@pytest.fixture(scope="module")
def det(spark):
    return spark.createDataFrame(
        [
            stored(60.9, "ddos", ["ddos"], "http", 200, 1.0),
            stored(61.1, "ddos", ["ddos"], "ssh", 500, 2.0),
            stored(119.99, "ddos", ["ddos"], "ssh", 300, 3.0),
            stored(120.0, "ddos", ["port_scan"]),
            stored(121.0, "ddos", []),
            stored(122.0, "normal", ["ddos", "port_scan"]),
        ],
        DET,
    )


def test_verdicts_cover_every_outcome(spark, det):
    quiet = spark.createDataFrame([stored(1, "normal", [])], DET)
    judged = monitoring.with_verdict(det.unionByName(quiet)).orderBy("timestamp").collect()
    assert [(r["verdict"], r["problem_rank"]) for r in judged] == [
        ("unclassified", 2), ("CORRECT", 2), ("CORRECT", 2), ("CORRECT", 2),
        ("WRONG TYPE", 2), ("MISSED", 1), ("FALSE POSITIVE", 0),
    ]


def test_alerts_fold_records_of_a_minute(det):
    rows = monitoring.top_alerts(monitoring.alerts(det)).collect()
    assert [r["verdict"] for r in rows] == ["FALSE POSITIVE", "MISSED", "WRONG TYPE", "CORRECT"]
    last = rows[-1].asDict()
    assert last["window_start"] == "1970-01-01 08:01"  # the zone was at UTC+8 then
    assert (last["event_count"], last["services_touched"], last["conn_min"], last["conn_max"]) == (3, 2, 200, 500)
    assert last["avg_latency_s"] == 2.0 and last["detected_as"] == "ddos" and last["rules_fired"] == "ddos_rule"
    assert rows[0]["detected_as"] == "ddos, port_scan"


def test_drill_down_reaches_the_rows_of_an_alert(det):
    alarms = monitoring.only_verdict(monitoring.alerts(det))
    rows = monitoring.drill_down(monitoring.raw_rows(det, row_key=["timestamp"]), alarms)
    assert sorted(r["timestamp"] for r in rows.collect()) == [120.0, 121.0, 122.0]


def test_drill_down_is_not_misled_by_a_repeated_hour(spark):
    """On 2024-11-03 New York has 01:30 twice, an hour apart."""
    first, second = 1730611800, 1730615400
    rows = spark.createDataFrame([stored(first, "ddos", []), stored(second, "normal", ["ddos"])], DET)
    zone = "America/New_York"
    alarms = monitoring.only_verdict(monitoring.alerts(rows, zone))
    found = monitoring.drill_down(monitoring.raw_rows(rows, zone, ["timestamp"]), alarms).collect()
    assert [r["timestamp"] for r in found] == [float(second)]


def test_latest_raw_rows_have_a_total_order(det):
    rows = monitoring.latest_raw_rows(monitoring.raw_rows(det, row_key=["timestamp"]), ["timestamp"], 4).collect()
    assert [r["timestamp"] for r in rows] == [122.0, 121.0, 120.0, 119.99]
    assert rows[-1]["event_time"] == "1970-01-01 08:01:59"


def test_recency_window_takes_its_instant_as_a_parameter(det):
    now = F.lit("2024-01-01 00:15:00").cast("timestamp")
    assert monitoring.latency_over_time(det, 15, now).count() == 1
    assert monitoring.latency_over_time(det, 14, now).count() == 0
    assert monitoring.latency_over_time(det, 15).count() == 0
    (row,) = monitoring.latency_over_time(det, None).collect()
    assert (row["p50_s"], row["max_s"]) == (0.75, 3.0)


def test_recency_window_reaches_the_scan(det, tmp_path):
    det.write.parquet(str(tmp_path / "det"))
    read = det.sparkSession.read.parquet(str(tmp_path / "det"))
    plan = monitoring.latency_over_time(read, 15)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(processed_at" in plan
    assert "ReadSchema: struct<latency_seconds:double,processed_at:timestamp>" in plan


def test_batch_health_and_running_totals(spark):
    rows = [(0, "normal", 10), (0, UNPARSEABLE, 1), (1, "ddos", 4), (5, INCOMPLETE, 2), (5, UNPARSEABLE, 3)]
    counts = spark.createDataFrame(rows, "batch_id long, label string, record_count long")
    health = monitoring.batch_health(counts)
    found = {r["batch_id"]: tuple(r)[1:] for r in health.collect()}
    assert found[0][:4] == (10, 1, 0, 11) and found[0][4] == pytest.approx(100 / 11)
    assert found[5] == (0, 3, 2, 5, 100.0)
    running = {r["batch_id"]: tuple(r)[3:] for r in monitoring.malformed_running(health).collect()}
    assert running == {0: (1, 0), 1: (1, 0), 5: (4, 2)}


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_running_totals_match_a_plain_loop(spark, block):
    rng = random.Random(block)
    ids = sorted(rng.sample(range(-50, 300), 90))
    rows = [(i, rng.randrange(9), rng.randrange(9)) for i in ids]
    df = spark.createDataFrame(rows, "n long, a long, b long").repartition(3)
    found = sorted(tuple(r) for r in running_totals(df, "n", {"sa": "a", "sb": "b"}, block).collect())
    a = b = 0
    want = []
    for n, x, y in rows:
        a, b = a + x, b + y
        want.append((n, x, y, a, b))
    assert found == want
    before = sorted(tuple(r) for r in previous_value(df.select("n"), "n", "p", block).collect())
    assert before == list(zip(ids, [None, *ids[:-1]]))


def brute_streaks(batches, every=30):
    listed = dict(batches)
    streaks, run = [], []
    for n in range(min(listed), max(listed) + 2):
        if n <= max(listed) and not listed.get(n):
            run.append(n)
        elif run:
            notices = sum(1 for place in range(1, len(run) + 1) if place == 1 or place % every == 0)
            streaks.append((run[0], run[-1], len(run), notices))
            run = []
    return streaks


@pytest.mark.parametrize("every", [1, 4, 30])
def test_idle_streaks_match_a_plain_loop(spark, every):
    rng = random.Random(every)
    batches = [(n, rng.choice([0, 0, 0, 5])) for n in range(400) if rng.random() < 0.5]
    batches = [(0, 0), *batches[1:], (500, 0)]
    df = spark.createDataFrame(batches, "batch_id long, records long")
    found = sorted(tuple(r) for r in monitoring.idle_streaks(df, every).collect())
    assert found == brute_streaks(batches, every)


def test_idle_streaks_at_the_edges(spark):
    schema = "batch_id long, records long"
    assert monitoring.idle_streaks(spark.createDataFrame([(4, 1), (5, 2)], schema)).count() == 0
    all_idle = monitoring.idle_streaks(spark.createDataFrame([(n, 0) for n in range(60)], schema)).collect()
    assert [tuple(r) for r in all_idle] == [(0, 59, 60, 3)]
    assert monitoring.idle_streaks(spark.createDataFrame([], schema)).count() == 0


def test_batch_cost_line(spark):
    rows = [(n, 1000.0 + 0.04 * n) for n in (4500, 10700, 15000)] + [(0, 19.0)]
    fit = monitoring.batch_cost_fit(spark.createDataFrame(rows, "records long, batch_ms double")).first()
    assert fit["batches"] == 3
    assert fit["ms_per_record"] == pytest.approx(0.04) and fit["fixed_ms"] == pytest.approx(1000.0)


def test_throughput_skips_the_counters(spark):
    counts = spark.createDataFrame(
        [("ddos", 1, 3), ("normal", 1, 4), (UNPARSEABLE, 1, 9), ("normal", 2, 5)],
        "label string, m int, record_count long",
    ).selectExpr("*", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, m) AS batch_time")
    assert [r["records"] for r in monitoring.throughput(counts, None).collect()] == [7, 5]
