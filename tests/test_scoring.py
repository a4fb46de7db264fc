"""Metric arithmetic on a fixture whose answers are known."""

from __future__ import annotations

import pytest

from wardline.operators import monitoring, scoring
from wardline.schema import INCOMPLETE, UNPARSEABLE

# label: stored, caught, claimed, claimed rightly, traffic (fixed values)
GOLDEN = {
    "brute_force": (372, 372, 372, 372, 372),
    "data_exfiltration": (372, 361, 398, 361, 372),
    "ddos": (372, 372, 372, 372, 372),
    "malicious_download": (372, 357, 557, 357, 372),
    "malware_c2": (372, 372, 385, 372, 372),
    "normal": (250, 250, 0, 0, 42408),
    "port_scan": (372, 372, 372, 372, 372),
}


@pytest.fixture(scope="module")
def det(spark):
    """Rows that give exactly the golden tallies."""
    rows = []
    for label, (stored, caught, _, correct, _) in GOLDEN.items():
        if label != "normal":
            rows += [(label, [label], True, 0.4)] * correct
            rows += [(label, [], False, 0.4)] * (stored - caught)
    wrong = [t for t, (_, _, claimed, right, _) in GOLDEN.items() for _ in range(claimed - right)]
    # 250 false alarms share all wrong claims, one each
    rows += [("normal", [t], True, 0.4) for t in wrong]
    assert len(wrong) == 250
    return spark.createDataFrame(
        rows,
        "label string, matched_attack_types array<string>, is_detection boolean, latency_seconds double",
    ).selectExpr("*", "matched_attack_types AS matched_rule_ids", "0L AS batch_id")


@pytest.fixture(scope="module")
def counts(spark):
    rows = [(0, label, n[4]) for label, n in GOLDEN.items()]
    rows += [(1, INCOMPLETE, 1), (2, UNPARSEABLE, 2)]
    return spark.createDataFrame(rows, "batch_id long, label string, record_count long").selectExpr(
        "*", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, batch_id) AS batch_time"
    )


def test_overall(det, counts):
    m = scoring.overall_metrics(det, counts).first().asDict()
    assert (m["tp"], m["fn"], m["fp"], m["tn"]) == (2206, 26, 250, 42158)
    assert (m["normal_total"], m["attack_total"], m["total_records"]) == (42408, 2232, 44640)
    assert m["precision"] == pytest.approx(2206 / 2456)
    assert m["recall"] == pytest.approx(2206 / 2232)
    assert m["f1"] == pytest.approx(0.941085, abs=5e-4)
    assert m["false_positive_rate"] == pytest.approx(250 / 42408)
    assert m["accuracy"] == pytest.approx(44364 / 44640)


def test_malformed(counts):
    m = scoring.malformed_rate(counts).first()
    assert m["malformed_total"] == 3 and m["malformed_rate"] == pytest.approx(3 / 44643)
    assert [tuple(r) for r in scoring.malformed_totals(counts).collect()] == [(INCOMPLETE, 1), (UNPARSEABLE, 2)]
    kinds = {r[0]: r[1] for r in monitoring.malformed_by_kind(counts).collect()}
    assert kinds == {"Incomplete (generation/schema)": 1, "Unparseable (transmission)": 2}


def test_labels(det, counts):
    rows = {r["label"]: r for r in scoring.label_metrics(det, counts).collect()}
    assert list(rows) == sorted(set(GOLDEN) - {"normal"})
    for label, r in rows.items():
        stored, caught, claimed, correct, traffic = GOLDEN[label]
        assert (r["stored"], r["caught"], r["predicted"], r["correct"], r["support"]) == (
            stored, caught, claimed, correct, traffic)
        assert r["missed"] == stored - caught
    assert rows["ddos"]["recall"] == 1.0
    assert rows["malicious_download"]["recall"] == pytest.approx(357 / 372)
    assert rows["malicious_download"]["precision"] == pytest.approx(357 / 557)


def test_attribution_and_outcome(det):
    found = {r[0]: tuple(r)[1:] for r in scoring.attribution(det).collect()}
    assert found == {label: n[2:4] for label, n in GOLDEN.items() if n[2]}
    outcome = {r[0]: tuple(r)[1:] for r in scoring.outcome_per_label(det).collect()}
    assert outcome == {label: n[:2] for label, n in GOLDEN.items()}


def test_integrity_passes(det, counts):
    checks = scoring.integrity(det, counts).collect()
    assert len(checks) == 6 + 4 and all(r["passed"] for r in checks)


def test_integrity_sees_lost_rows_and_missing_classes(det, counts):
    failed = scoring.integrity(det.where("label <> 'ddos'"), counts).where("NOT passed").collect()
    assert [(r["label"], r["expected"], r["actual"]) for r in failed] == [("ddos", 372.0, 0.0)]
    failed = scoring.integrity(det, counts.where("label <> 'port_scan'")).where("NOT passed").collect()
    assert [r["label"] for r in failed] == ["port_scan"]


def test_integrity_sees_reserved_labels_and_skewed_clocks(spark, det, counts):
    odd = spark.createDataFrame(
        [(UNPARSEABLE, [], False, -1.0, [], 0)], det.select(
            "label", "matched_attack_types", "is_detection", "latency_seconds", "matched_rule_ids", "batch_id"
        ).schema)
    failed = {r["check_name"] for r in scoring.integrity(det.unionByName(odd), counts).where("NOT passed").collect()}
    assert {"no_reserved_label_stored", "no_clock_skew"} <= failed


def test_window_baseline_mix_and_ratio(det, counts):
    assert scoring.batch_window(counts).first()["batches"] == 3
    base = scoring.baseline_accuracy(det, counts).first()
    assert base["baseline_accuracy"] == pytest.approx(42408 / 44640)
    assert base["lift"] == pytest.approx(44364 / 44640 - 42408 / 44640)
    shares = {r["label"]: r["share"] for r in scoring.class_mix(counts).collect()}
    assert shares["normal"] == pytest.approx(0.95, abs=1e-9) and sum(shares.values()) == pytest.approx(1)
    assert scoring.storage_ratio(det, counts).first()["storage_ratio"] == pytest.approx(2482 / 44643)


def test_false_positives_by_rule(det, counts):
    rows = [tuple(r) for r in scoring.false_positives_by_rule(det, counts).collect()]
    assert [r[:2] for r in rows] == [("malicious_download", 200), ("data_exfiltration", 37), ("malware_c2", 13)]
    assert rows[0][2] == pytest.approx(200 / 42408)


def test_no_rows_give_zeros_and_nulls(det, counts):
    m = scoring.overall_metrics(det.limit(0), counts.limit(0)).first().asDict()
    assert m["tp"] == m["tn"] == m["total_records"] == 0
    assert m["precision"] is m["recall"] is m["f1"] is m["accuracy"] is m["false_positive_rate"] is None
    assert monitoring.accuracy_kpis(det.limit(0), counts.limit(0)).first()["recall"] is None
    assert scoring.latency_summary(det.limit(0)).first()["p50"] is None


def test_f1_is_null_when_a_part_is_zero(spark, counts):
    det = spark.createDataFrame(
        [("ddos", [], False), ("normal", ["ddos"], True)],
        "label string, matched_attack_types array<string>, is_detection boolean")
    m = scoring.overall_metrics(det, counts).first()
    assert m["precision"] == m["recall"] == 0.0 and m["f1"] is None


def test_reserved_pattern_and_prefix_differ(spark):
    counts = spark.createDataFrame(
        [(0, "__half", 5), (0, "ddos", 2), (0, "normal", 3), (0, UNPARSEABLE, 7)],
        "batch_id long, label string, record_count long")
    det = spark.createDataFrame([], "label string, is_detection boolean")
    assert {r[0] for r in scoring.traffic_totals(counts).collect()} == {"__half", "ddos", "normal"}
    kpis = monitoring.volume_kpis(det, counts).first()
    assert kpis["total_records"] == 5 and kpis["attack_records"] == 2


def test_claim_of_a_class_that_never_occurs(spark):
    det = spark.createDataFrame(
        [("normal", ["ghost"], True)], "label string, matched_attack_types array<string>, is_detection boolean")
    counts = spark.createDataFrame([("normal", 9)], "label string, record_count long")
    (r,) = scoring.label_metrics(det, counts).collect()
    assert (r["label"], r["support"], r["stored"], r["predicted"], r["precision"], r["recall"]) == (
        "ghost", 0, 0, 1, 0.0, None)


def test_run_compare(spark):
    a = spark.createDataFrame([("recall", "*", 0.5)], "metric string, label string, value double")
    b = spark.createDataFrame([("recall", "*", 0.75), ("recall", "x", 1.0)], a.schema)
    rows = [tuple(r) for r in scoring.run_compare(a, b).collect()]
    assert rows == [("recall", "*", 0.5, 0.75, 0.25), ("recall", "x", None, 1.0, None)]


def test_offline_scores(det):
    scores = {r["label"]: r["recall"] for r in scoring.offline_score(det).collect()}
    assert scores["data_exfiltration"] == pytest.approx(361 / 372)
    assert scoring.offline_fp_rate(det).first()["false_positives"] == 250
    assert scoring.attribution_mismatch(det).first()["mismatches"] == 0


def test_long_metrics_agree_with_the_tables(det, counts):
    long = {(r["metric"], r["label"]): r["value"] for r in scoring.long_metrics(det, counts).collect()}
    overall = scoring.overall_metrics(det, counts).first()
    for name in ("precision", "recall", "f1", "false_positive_rate", "accuracy"):
        assert long.pop((name, "*")) == pytest.approx(overall[name])
    for r in scoring.label_metrics(det, counts).collect():
        for name in ("precision", "recall", "f1"):
            assert long.pop((name, r["label"])) == r[name]
    assert long == {}


def test_fanning_claims_out_does_not_evaluate_rules_twice(spark):
    from conftest import plan_text

    from wardline.operators.rules import evaluate, parse_rules

    rules = parse_rules([{"rule_id": "r", "attack_type": "t", "severity": "low",
                          "conditions": [{"field": "count", "op": ">=", "value": 123}]}])
    df = spark.range(9).selectExpr("int(id) AS count", "'normal' AS label", "id AS record_count")
    judged = evaluate(df, rules)
    assert plan_text(scoring.attribution(judged)).count(">= 123") == 1
    assert plan_text(scoring.label_metrics(judged, df)).count(">= 123") == 1
    assert plan_text(scoring.false_positives_by_rule(judged, df)).count(">= 123") == 1
