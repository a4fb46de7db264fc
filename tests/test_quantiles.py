from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import plan_text
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wardline.functions.quantiles import exact_quantiles

PROBABILITIES = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def expected(values):
    return [pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12) for p in PROBABILITIES.values()]


def one(spark, values, **settings):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return list(exact_quantiles(df, "x", PROBABILITIES, **settings).first())


def test_matches_numpy(spark):
    rng = random.Random(7)
    values = [rng.expovariate(0.1) for _ in range(3000)] + [5.0] * 1500 + [-3.25, 1e6]
    assert one(spark, values) == expected(values)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1000, 1000, allow_nan=False), min_size=1, max_size=40), st.sampled_from([(0.01,), (1.0, 0.5), (500.0, 7.0, 0.1)]))
def test_any_values_and_widths(spark, values, widths):
    assert one(spark, values, widths=widths) == expected(values)


def test_one_value_holding_most_rows(spark):
    values = [2.0] * 5000 + [1.0] * 10 + [3.0] * 10
    assert one(spark, values) == expected(values)


def test_values_far_apart(spark):
    values = [1e9 + i * 1e-3 for i in range(2000)] + [i * 1e-6 for i in range(2000)] + [-5e8]
    assert one(spark, values) == expected(values)


def test_nulls_are_ignored_and_nan_sorts_last(spark):
    assert one(spark, [1.0, None, 3.0])[1] == 2.0
    low, mid, *_, top = one(spark, [1.0, 2.0, float("nan")])
    assert (low, mid) == (1.0, 2.0) and np.isnan(top)
    assert one(spark, [1.0, float("inf"), float("inf")])[1] == float("inf")


def test_groups_with_null_keys(spark):
    rows = [("a", 1, 1.0), ("a", 1, 2.0), ("a", None, 10.0), (None, 1, 7.0), (None, 1, 9.0), ("b", 2, None)]
    df = spark.createDataFrame(rows, "g string, h int, x double")
    found = {(r["g"], r["h"]): r["m"] for r in exact_quantiles(df, "x", {"m": 0.5}, by=["g", "h"]).collect()}
    assert found == {("a", 1): 1.5, ("a", None): 10.0, (None, 1): 8.0}


def test_no_rows_no_groups(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert exact_quantiles(df, "x", {"m": 0.5}, by=["g"]).count() == 0


def test_rows_are_counted_before_they_are_shuffled(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "double(id % 5) AS x")
    text = plan_text(exact_quantiles(df, "x", {"m": 0.5}, by=["g"]))
    lowest = [line for line in text.splitlines() if "HashAggregate" in line][-1]
    assert "partial_count" in lowest and "_value" in lowest
    assert "Cartesian" not in text and "BroadcastNestedLoop" not in text


def test_one_coarse_bucket_without_automatic_broadcasts(spark):
    """All values share the coarse bucket; no join shuffles on that one key."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.range(20_000).selectExpr("pmod(id * 7919, 20011) / 400.0D AS x")
        result = exact_quantiles(frame, "x", PROBABILITIES)
        values = [r["x"] for r in frame.collect()]
        assert list(result.first()) == expected(values)
        assert "SortMergeJoin" not in plan_text(result) and plan_text(result).count("BroadcastHashJoin") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_junk_clocks_share_the_outermost_buckets(spark):
    values = [1.7e9 + i * 64.0 for i in range(3000)] + [-1e18, 1e18, 4e15] + [i / 7 for i in range(3001)]
    assert one(spark, values) == expected(values)


def test_groups_are_zoomed_once(spark):
    frame = spark.range(1000).selectExpr("id % 5 AS g", "id / 3.0D AS x")
    grouped = plan_text(exact_quantiles(frame, "x", PROBABILITIES, by=["g"]))
    assert grouped.count("Window ") <= 4 and grouped.count("Exchange hashpartitioning") <= 10
