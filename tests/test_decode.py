from __future__ import annotations

import json

import pytest
from conftest import PYTHON_NODES, plan_text, record

from wardline.operators.decode import decode, fields_present, parse_messages
from wardline.operators.rules import evaluate
from wardline.operators.shipped_rules import shipped_rules
from wardline.schema import INCOMPLETE, RECORD_FIELDS, UNPARSEABLE, VALID

GOOD = record(timestamp=1.5, label="ddos")


def text(**changes) -> str:
    return json.dumps({**GOOD, **changes})


def without(*names) -> str:
    return json.dumps({k: v for k, v in GOOD.items() if k not in names})


CASES = {
    "complete": (text(), VALID, "ddos"),
    "not json": ("not json at all", UNPARSEABLE, UNPARSEABLE),
    "one optional field": ('{"duration": 1.0}', INCOMPLETE, INCOMPLETE),
    "mistyped optional field": (text(count="abc"), VALID, "ddos"),
    "overflow in an int": (text(count=2**40), VALID, "ddos"),
    "empty": ("", UNPARSEABLE, UNPARSEABLE),
    "blank": ("   ", UNPARSEABLE, UNPARSEABLE),
    "null value": (None, UNPARSEABLE, UNPARSEABLE),
    "empty object": ("{}", UNPARSEABLE, UNPARSEABLE),
    "number": ("42", UNPARSEABLE, UNPARSEABLE),
    "json null": ("null", UNPARSEABLE, UNPARSEABLE),
    "cut short": (text()[:200], UNPARSEABLE, UNPARSEABLE),
    "array of one": (f"[{text()}]", UNPARSEABLE, UNPARSEABLE),
    "unknown keys only": ('{"x": 1}', UNPARSEABLE, UNPARSEABLE),
    "unknown key besides": (text(x=1), VALID, "ddos"),
    "number in a text field": (text(service=5), VALID, "ddos"),
    "required null": (text(flag=None), INCOMPLETE, INCOMPLETE),
    "no label": (without("label"), INCOMPLETE, INCOMPLETE),
    "no timestamp": (without("timestamp"), INCOMPLETE, INCOMPLETE),
    "mistyped required field": (text(timestamp="soon"), INCOMPLETE, INCOMPLETE),
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(name, case[0]) for name, case in CASES.items()]
    return parse_messages(spark.createDataFrame(rows, "name string, value string"), keep=["name"])


def test_classification(parsed):
    found = {r["name"]: (r["_status"], r["_count_label"]) for r in parsed.collect()}
    assert found == {name: case[1:] for name, case in CASES.items()}


def test_values_and_coercions(parsed):
    rows = {r["name"]: r for r in parsed.collect()}
    assert rows["mistyped optional field"]["count"] is None
    assert rows["overflow in an int"]["count"] is None
    assert rows["number in a text field"]["service"] == "5"
    assert [rows["complete"][n] for n in RECORD_FIELDS] == [GOOD[n] for n in RECORD_FIELDS]


def test_fields_present(parsed):
    counts = {r["name"]: r["n"] for r in parsed.select("name", fields_present().alias("n")).collect()}
    assert counts["complete"] == 43
    assert counts["one optional field"] == 1
    assert counts["mistyped optional field"] == 42
    assert counts["cut short"] == counts["empty"] == 0


def test_binary_payloads_decode(spark):
    df = spark.createDataFrame([(bytearray(text().encode()),)], "value binary")
    assert parse_messages(df).first()["_status"] == VALID


def test_malformed_rows_never_match(parsed):
    judged = evaluate(parsed, shipped_rules()).where("_status <> 'valid'")
    assert judged.where("is_detection").count() == 0


def test_json_is_parsed_once_per_row(parsed):
    plan = plan_text(evaluate(parsed, shipped_rules()).where("label <> 'normal' OR is_detection"))
    assert plan.count("from_json") == 1
    assert not any(node in plan for node in PYTHON_NODES)


def test_decode_keeps_named_columns_only(spark):
    df = spark.createDataFrame([("a", text(), 1)], "name string, value string, other int")
    assert decode(df, keep=["name"]).columns == ["name", *RECORD_FIELDS]
