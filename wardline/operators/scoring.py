"""Accuracy of the detector, computed from the two stored tables.

``det`` is the detections table, ``counts`` the per-batch counts table.  Each
result is one plan of partial aggregates over the needed columns; one-row
aggregates are stacked and folded instead of cross-joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.expressions import (
    count_where,
    each_of,
    harmonic_mean,
    is_attack,
    is_normal,
    is_real_traffic,
    is_reserved,
    ratio,
    total,
)
from wardline.functions.quantiles import exact_quantiles
from wardline.functions.running import one_row
from wardline.schema import LATENCY_TARGET_SECONDS


def _combinations(det: DataFrame, claimed: str = "matched_attack_types") -> DataFrame:
    """Stored rows counted per (label, claims, flagged).

    There are few such combinations however many rows there are, so whatever
    fans claims out to one row each runs on this instead of on the rows.
    """
    return det.groupBy("label", claimed, "is_detection").agg(F.count(F.lit(1)).alias("_rows"))


def outcome_per_label(det: DataFrame) -> DataFrame:
    return (
        det.groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("stored"),
            count_where(F.col("is_detection")).alias("caught"),
        )
        .orderBy("label")
    )


def attribution(
    det: DataFrame, claims_name: str = "predicted", correct_name: str = "correct"
) -> DataFrame:
    """Per claimed type: how often the rules claimed it, how often rightly."""
    claims = each_of(_combinations(det), "matched_attack_types", "attack_type", "label", "_rows")
    right = F.when(F.col("label") == F.col("attack_type"), F.col("_rows"))
    return (
        claims.groupBy("attack_type")
        .agg(total(F.col("_rows")).alias(claims_name), total(right).alias(correct_name))
        .orderBy("attack_type")
    )


def traffic_totals(counts: DataFrame) -> DataFrame:
    return (
        counts.where(is_real_traffic())
        .groupBy("label")
        .agg(total(F.col("record_count")).alias("total"))
        .orderBy("label")
    )


def malformed_totals(counts: DataFrame) -> DataFrame:
    return (
        counts.where(is_reserved())
        .groupBy("label")
        .agg(total(F.col("record_count")).alias("total"))
        .orderBy("label")
    )


def latency_summary(
    det: DataFrame, target: float = LATENCY_TARGET_SECONDS, approximate: bool = False
) -> DataFrame:
    """One row of latency statistics over the stored rows.

    Exact percentiles by default; ``approximate`` trades them for a single
    bounded sketch.
    """
    quantiles = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
    latency = F.col("latency_seconds")
    basics = det.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(latency).alias("mean"),
        F.max(latency).alias("max"),
        F.min(latency).alias("min"),
        count_where(latency < target).alias("under_target"),
    )
    if approximate:
        ranks = det.agg(
            *[F.percentile_approx(latency, p, 10000).alias(n) for n, p in quantiles.items()]
        )
    else:
        ranks = exact_quantiles(det, "latency_seconds", quantiles)
    return one_row(basics, ranks).select(
        "n", "mean", "p50", "p95", "p99", "max", "min", "under_target",
        ratio(F.col("under_target"), F.col("n")).alias("under_target_pct"),
    )


def batch_key(counts: DataFrame) -> list[str]:
    """What tells batches apart: their id, and the run where several are stored."""
    return [name for name in ("run_id", "batch_id") if name in counts.columns]


def batch_window(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count_distinct(F.struct(*batch_key(counts))).alias("batches"),
        F.min("batch_time").alias("first_seen"),
        F.max("batch_time").alias("last_seen"),
    )


# --- confusion and rates ----------------------------------------------------

def confusion(det: DataFrame, counts: DataFrame) -> DataFrame:
    """TP, FN, FP from stored rows; TN and volumes from the counts table."""
    stored = det.agg(
        count_where(is_attack() & F.col("is_detection")).alias("tp"),
        count_where(is_attack() & ~F.col("is_detection")).alias("fn"),
        # a normal row is only ever stored because a rule fired on it
        count_where(is_normal()).alias("fp"),
    )
    real = counts.where(is_real_traffic())
    seen = real.agg(
        total(F.col("record_count")).alias("total_records"),
        total(F.when(is_normal(), F.col("record_count"))).alias("normal_total"),
    )
    return one_row(stored, seen).select(
        "tp", "fn", "fp",
        (F.col("normal_total") - F.col("fp")).alias("tn"),
        "normal_total",
        (F.col("total_records") - F.col("normal_total")).alias("attack_total"),
        "total_records",
    )


def with_rates(matrix: DataFrame) -> DataFrame:
    tp, fn, fp, tn = (F.col(name) for name in ("tp", "fn", "fp", "tn"))
    return matrix.select(
        "*",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(fp, F.col("normal_total")).alias("false_positive_rate"),
        ratio(tp + tn, F.col("total_records")).alias("accuracy"),
    ).withColumn("f1", harmonic_mean(F.col("precision"), F.col("recall")))


def overall_metrics(det: DataFrame, counts: DataFrame) -> DataFrame:
    return with_rates(confusion(det, counts))


def malformed_rate(counts: DataFrame) -> DataFrame:
    n = F.col("record_count")
    return counts.agg(
        total(F.when(is_reserved(), n)).alias("malformed_total"),
        total(n).alias("messages"),
    ).select(
        "malformed_total", "messages",
        ratio(F.col("malformed_total"), F.col("messages")).alias("malformed_rate"),
    )


def _label_tallies(det: DataFrame, counts: DataFrame) -> DataFrame:
    """Stored outcome, claims and traffic side by side, one row per label.

    Equal to a full outer join of the three label-keyed aggregates, but read
    in one pass over each table: a combination of stored rows contributes one
    entry for its own label and one for every type it claims.
    """
    rows, none = F.col("_rows"), F.lit(None).cast("bigint")

    def entry(label, stored, caught, predicted, correct):
        return F.struct(
            label.alias("label"), stored.alias("stored"), caught.alias("caught"),
            predicted.alias("predicted"), correct.alias("correct"),
        )

    own = entry(F.col("label"), rows, F.when(F.col("is_detection"), rows).otherwise(0), none, none)
    claimed = F.transform(
        "matched_attack_types",
        lambda t: entry(t, none, none, rows, F.when(t == F.col("label"), rows).otherwise(0)),
    )
    stored = _combinations(det).select(F.inline(F.concat(F.array(own), claimed)))
    traffic = counts.where(is_real_traffic()).select("label", F.col("record_count").alias("traffic"))
    return (
        stored.unionByName(traffic, allowMissingColumns=True)
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("stored", "caught", "predicted", "correct", "traffic")])
    )


def _is_scored() -> Column:
    """Classes that get a score: stored attacks, and whatever was claimed."""
    return (F.col("stored").isNotNull() & is_attack()) | F.col("predicted").isNotNull()


def _own_tallies() -> dict[str, Column]:
    """A class's tallies; stored normal rows are false alarms, not recall."""
    def of_attack(name: str) -> Column:
        return F.when(is_normal(), F.lit(0)).otherwise(F.coalesce(name, F.lit(0)))

    return {
        "stored": of_attack("stored"),
        "caught": of_attack("caught"),
        "predicted": F.coalesce("predicted", F.lit(0)),
        "correct": F.coalesce("correct", F.lit(0)),
    }


def _own_rates() -> dict[str, Column]:
    tally = _own_tallies()
    recall = ratio(tally["caught"], tally["stored"])
    precision = ratio(tally["correct"], tally["predicted"])
    return {"recall": recall, "precision": precision, "f1": harmonic_mean(precision, recall)}


def label_metrics(det: DataFrame, counts: DataFrame) -> DataFrame:
    """Per-class support, outcome, attribution and the rates from them.

    Recall asks whether any rule fired on the class, precision whether claims
    of the class were right; normal rows count against the class they were
    claimed for.  Classes neither stored nor claimed are left out.  A stored
    row whose label looks reserved is a class like any other; its traffic counts
    as malformed, so its support is what is stored, and ``integrity`` reports it.
    """
    tally = _own_tallies()
    columns = {
        "support": F.coalesce("traffic", "stored", F.lit(0)),
        **tally,
        "missed": tally["stored"] - tally["caught"],
        **_own_rates(),
    }
    return (
        _label_tallies(det, counts)
        .where(_is_scored())
        .select("label", *[column.alias(name) for name, column in columns.items()])
        .orderBy("label")
    )


# --- integrity --------------------------------------------------------------

def integrity(det: DataFrame, counts: DataFrame) -> DataFrame:
    """Cross-checks that expose lost rows, half-written batches and clock skew.

    Per attack class the two tables must agree, also for classes present in
    only one of them; a stored row must not carry a reserved label.
    """
    def check(name: str, label, passed, expected, actual) -> list:
        return [
            F.lit(name).alias("check_name"),
            label.alias("label"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            expected.cast("double").alias("expected"),
            actual.cast("double").alias("actual"),
        ]

    nobody = F.lit(None).cast("string")
    expected, actual = F.coalesce("traffic", F.lit(0)), F.coalesce("stored", F.lit(0))
    per_label = (
        _label_tallies(det, counts)
        .where(is_attack())
        .where(F.col("stored").isNotNull() | F.col("traffic").isNotNull())
        .select(*check("stored_matches_traffic", F.col("label"), expected == actual, expected, actual))
    )
    stored = det.agg(
        count_where(is_normal()).alias("fp"),
        count_where(is_reserved()).alias("reserved"),
        F.min("latency_seconds").alias("min_latency"),
        F.max("latency_seconds").alias("max_latency"),
    )
    seen = counts.where(is_normal()).agg(total(F.col("record_count")).alias("normal_total"))
    zero = F.lit(0)
    # one pass over the one-row summary, fanned out to a row per check
    checks = [
        F.struct(*check("false_positives_within_normal", nobody,
                        F.col("fp") <= F.col("normal_total"), F.col("normal_total"), F.col("fp"))),
        F.struct(*check("latency_not_negative", nobody,
                        F.coalesce(F.col("max_latency") >= 0, F.lit(True)), zero, F.col("max_latency"))),
        F.struct(*check("no_clock_skew", nobody,
                        F.coalesce(F.col("min_latency") >= 0, F.lit(True)), zero, F.col("min_latency"))),
        F.struct(*check("no_reserved_label_stored", nobody,
                        F.col("reserved") == 0, zero, F.col("reserved"))),
    ]
    whole = one_row(stored, seen).select(F.inline(F.array(*checks)))
    return per_label.unionByName(whole).orderBy("check_name", "label")


# --- published summaries ----------------------------------------------------

def false_positives_by_rule(det: DataFrame, counts: DataFrame) -> DataFrame:
    normal_total = (
        counts.where(is_normal()).agg(total(F.col("record_count")).alias("n")).scalar()
    )
    normal = _combinations(det.where(is_normal()), "matched_rule_ids")
    return (
        each_of(normal, "matched_rule_ids", "rule_id", "_rows")
        .groupBy("rule_id")
        .agg(total(F.col("_rows")).alias("false_positives"))
        .withColumn("rate", ratio(F.col("false_positives"), normal_total))
        .orderBy(F.desc("false_positives"), "rule_id")
    )


def storage_ratio(det: DataFrame, counts: DataFrame) -> DataFrame:
    return one_row(
        det.agg(F.count(F.lit(1)).alias("stored_rows")),
        counts.agg(total(F.col("record_count")).alias("ingested")),
    ).select(
        "stored_rows", "ingested",
        ratio(F.col("stored_rows"), F.col("ingested")).alias("storage_ratio"),
    )


def baseline_accuracy(det: DataFrame, counts: DataFrame) -> DataFrame:
    """Accuracy against a detector that flags nothing."""
    return overall_metrics(det, counts).select(
        "accuracy",
        ratio(F.col("normal_total"), F.col("total_records")).alias("baseline_accuracy"),
    ).withColumn("lift", F.col("accuracy") - F.col("baseline_accuracy"))


def class_mix(counts: DataFrame) -> DataFrame:
    real = counts.where(is_real_traffic())
    everything = real.agg(total(F.col("record_count")).alias("n")).scalar()
    return (
        real.groupBy("label")
        .agg(total(F.col("record_count")).alias("records"))
        .withColumn("share", ratio(F.col("records"), everything))
        .orderBy("label")
    )


def table_counts(det: DataFrame, counts: DataFrame) -> DataFrame:
    def sized(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )

    return sized("detections", det).unionByName(sized("traffic_counts", counts))


def long_metrics(det: DataFrame, counts: DataFrame) -> DataFrame:
    """Headline and per-class rates as (metric, label, value) rows.

    The headline (label ``*``) is the rollup of the per-class tallies, so each
    table is read once for both.
    """
    tallies = _label_tallies(det, counts)
    attack, normal = F.when(is_attack(), 1).otherwise(0), F.when(is_normal(), 1).otherwise(0)
    stored, caught, traffic = (F.coalesce(c, F.lit(0)) for c in ("stored", "caught", "traffic"))
    marked = tallies.withColumns(
        {
            "tp": attack * caught,
            "fn": attack * (stored - caught),
            "fp": normal * stored,
            "normal_total": normal * traffic,
            "total_records": traffic,
            "scored": _is_scored(),
        }
    )
    sums = ["stored", "caught", "predicted", "correct", "traffic", "tp", "fn", "fp",
            "normal_total", "total_records"]
    rolled = marked.rollup("label").agg(
        F.grouping("label").cast("boolean").alias("is_total"),
        F.max("scored").alias("scored"),
        *[F.sum(c).alias(c) for c in sums],
    )
    rated = with_rates(rolled.withColumn("tn", F.col("normal_total") - F.col("fp"))).where(
        F.col("is_total") | F.col("scored")
    )
    own = _own_rates()
    pairs = [
        F.struct(
            F.lit(name).alias("metric"),
            F.when(F.col("is_total"), F.lit("*")).otherwise(F.col("label")).alias("label"),
            F.when(F.col("is_total"), F.col(name)).otherwise(own.get(name)).cast("double").alias("value"),
        )
        for name in ("precision", "recall", "f1", "false_positive_rate", "accuracy")
    ]
    return (
        rated.select("is_total", F.inline(F.array(*pairs)))
        .where(F.col("is_total") | F.col("metric").isin(list(own)))
        .drop("is_total")
    )


def run_compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two runs' ``long_metrics`` side by side, with the difference."""
    a = left.withColumnRenamed("value", "left_value")
    b = right.withColumnRenamed("value", "right_value")
    return (
        a.unionByName(b, allowMissingColumns=True)
        .groupBy("metric", "label")
        .agg(F.max("left_value").alias("left_value"), F.max("right_value").alias("right_value"))
        .withColumn("delta", F.col("right_value") - F.col("left_value"))
        .orderBy("metric", "label")
    )


# --- scoring without stored tables ------------------------------------------

def offline_score(evaluated: DataFrame) -> DataFrame:
    """Recall per attack class, straight from evaluated records."""
    return (
        evaluated.where(is_attack())
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("total"), count_where(F.col("is_detection")).alias("caught"))
        .withColumn("recall", ratio(F.col("caught"), F.col("total")))
        .orderBy("label")
    )


def offline_fp_rate(evaluated: DataFrame) -> DataFrame:
    return evaluated.agg(
        count_where(is_normal()).alias("normal_total"),
        count_where(is_normal() & F.col("is_detection")).alias("false_positives"),
    ).withColumn("false_positive_rate", ratio(F.col("false_positives"), F.col("normal_total")))


def attribution_mismatch(evaluated: DataFrame) -> DataFrame:
    """Caught attacks none of whose claimed types is the true one."""
    wrong = (
        is_attack()
        & F.col("is_detection")
        & ~F.array_contains("matched_attack_types", F.col("label"))
    )
    return evaluated.agg(count_where(wrong).alias("mismatches"))
