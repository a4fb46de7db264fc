"""Every query against its SQL counterpart, and what its plan may contain."""

from __future__ import annotations

import compare
import duckdb
import pytest
from conftest import DATA, PYTHON_NODES, plan_text

import __spark_entry__ as contract
from wardline.plans.catalog import registered
from wardline.plans.oracle import ORACLE

QUERIES = registered()
ROWS_ONLY: set[str] = set()

SURVEYED = """
accuracy_kpis alert_drilldown alert_raw alerts alerts_false_positive alerts_top attribution
attribution_mismatch baseline_accuracy batch_cost_fit batch_health batch_window class_mix confusion
counts_per_batch delete_batch detections event_time_format fields_present fp_by_rule idle_streaks
integrity label_metrics latency_over_time latency_stamp latency_summary malformed_by_kind malformed_rate
malformed_running malformed_totals offline_fp_rate offline_score outcome_per_label overall_metrics
parse_classify precision_by_type recall_by_type report_export reset_tables rule_nulls rule_ops rules_empty
rules_evaluate run_compare sink_roundtrip storage_ratio stream_detect stream_ingest stream_progress
stream_resume runs_batch_window runs_batch_health runs_malformed_running table_counts throughput traffic_totals verdicts volume_kpis
""".split()


@pytest.fixture(scope="module")
def duck():
    return compare.duck(DATA)


def test_every_surveyed_operator_has_a_query():
    assert len(SURVEYED) == 58 and set(SURVEYED) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    text = plan_text(frame)
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert compare.differences(frame, duck, ORACLE[name]) == []


def test_the_data_is_dense_enough_to_decide(spark):
    """Checks pass and fail, alerts hold several rows, a recent window leaves something out."""
    checks = {r["passed"] for r in QUERIES["integrity"](spark, DATA).collect()}
    assert checks == {True, False}
    alerts = QUERIES["alerts"](spark, "/root/testdata/sf0.01").collect()
    assert max(r["event_count"] for r in alerts) > 2 and max(r["services_touched"] for r in alerts) > 2
    minutes = QUERIES["latency_over_time"](spark, DATA).collect()
    assert len(minutes) <= 16 and any(r["p50_s"] < r["p95_s"] < r["max_s"] for r in minutes)
    assert any(r["delta"] for r in QUERIES["run_compare"](spark, DATA).collect())


def test_entry_runs(spark):
    folder = "/root/testdata/sf0.001"
    assert compare.differences(contract.entry(spark), compare.duck(folder), contract.oracle_sql()["label_metrics"]) == []


# One minute, one event type and one value hold a third of all events.
HOT = """
SELECT event_id,
       CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-10 12:30:00' + INTERVAL (event_id % 50) SECOND
            ELSE ts END AS ts,
       user_id, CASE WHEN event_id % 3 = 0 THEN 'error' ELSE event_type END AS event_type,
       CASE WHEN event_id % 3 = 0 THEN 88.5 ELSE value END AS value, props
FROM events
"""


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    compare.duck(DATA).execute(f"COPY ({HOT}) TO '{folder}/events.parquet' (FORMAT parquet)")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    return str(folder), connection


@pytest.mark.parametrize(
    "name",
    "alerts alert_drilldown label_metrics latency_over_time latency_summary throughput batch_health "
    "malformed_running idle_streaks attribution fp_by_rule integrity verdicts counts_per_batch".split(),
)
def test_hot_groups_give_whole_results(spark, hot, name):
    folder, connection = hot
    assert compare.differences(QUERIES[name](spark, folder), connection, ORACLE[name]) == []
