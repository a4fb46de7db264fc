"""Column expressions shared by the scoring and monitoring queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.schema import DISPLAY_TIME_ZONE, INCOMPLETE, NORMAL_LABEL, UNPARSEABLE


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is null on a zero or null denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def harmonic_mean(precision: Column, recall: Column) -> Column:
    """F1; null when either part is null or exactly zero."""
    return F.when(
        (precision != 0) & (recall != 0), 2 * precision * recall / (precision + recall)
    )


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def total(value: Column) -> Column:
    """Sum that is 0 rather than null on no rows."""
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


# --- label predicates -------------------------------------------------------

def is_reserved(label: str = "label") -> Column:
    """Label is a malformed-record counter: two underscores on both ends."""
    return F.col(label).like(r"\_\_%\_\_")


def is_real_traffic(label: str = "label") -> Column:
    return ~is_reserved(label)


def has_reserved_prefix(label: str = "label") -> Column:
    """The dashboards' looser test: two leading underscores."""
    return F.col(label).startswith("__")


def is_normal(label: str = "label") -> Column:
    return F.col(label) == NORMAL_LABEL


def is_attack(label: str = "label") -> Column:
    return F.col(label) != NORMAL_LABEL


# --- verdicts ---------------------------------------------------------------

def verdict() -> Column:
    """How a stored row turned out, seen from its true label."""
    flagged = F.col("is_detection")
    return (
        F.when(is_normal() & flagged, "FALSE POSITIVE")
        .when(is_attack() & ~flagged, "MISSED")
        .when(is_attack() & F.array_contains("matched_attack_types", F.col("label")), "CORRECT")
        .when(is_attack() & flagged, "WRONG TYPE")
        .otherwise("unclassified")
    )


def problem_rank(verdict_column: str = "verdict") -> Column:
    """Sort key that puts false alarms first, then misses, then the rest."""
    outcome = F.col(verdict_column)
    return F.when(outcome == "FALSE POSITIVE", 0).when(outcome == "MISSED", 1).otherwise(2)


def failure_kind(label: str = "label") -> Column:
    return (
        F.when(F.col(label) == UNPARSEABLE, "Unparseable (transmission)")
        .when(F.col(label) == INCOMPLETE, "Incomplete (generation/schema)")
        .otherwise(F.col(label))
    )


def each_of(df: DataFrame, array_column: str, name: str, *keep: str) -> DataFrame:
    """One row per array element; empty arrays give no row.

    A plain explode makes Spark add a "not empty" filter and push it to the
    scan.  Where the array is computed in the same plan - by rule evaluation -
    that evaluates every rule a second time for every row.
    """
    return df.select(*keep, F.explode_outer(array_column).alias(name)).where(F.col(name).isNotNull())


def listed(array_column: str) -> Column:
    return F.array_join(array_column, ", ")


# --- time -------------------------------------------------------------------

# fixed values: the three display formats
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
CLOCK_FORMAT = "HH:mm:ss"


def event_instant(epoch_seconds: str = "timestamp") -> Column:
    """Epoch seconds as a timestamp, whole seconds."""
    return F.timestamp_seconds(F.floor(F.col(epoch_seconds)))


def minute_of(instant: Column) -> Column:
    return F.date_trunc("minute", instant)


def display_time(instant: Column, pattern: str, zone: str = DISPLAY_TIME_ZONE) -> Column:
    """Wall-clock text in the viewers' zone; the session itself runs in UTC."""
    return F.date_format(F.from_utc_timestamp(instant, zone), pattern)
