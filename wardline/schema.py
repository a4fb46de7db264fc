"""The record contract: fields, required fields, reserved labels, stored tables.

Everything here is a declaration.  The record has a fixed, explicit schema so
that no job ever pays for (or is surprised by) schema inference.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: the 43-field connection record ---------------------------
BASIC_FIELDS = """
    duration double, protocol_type string, service string, flag string,
    src_bytes int, dst_bytes int, land int, wrong_fragment int, urgent int
"""
CONTENT_FIELDS = """
    hot int, num_failed_logins int, logged_in int, num_compromised int,
    root_shell int, su_attempted int, num_root int, num_file_creations int,
    num_shells int, num_access_files int, num_outbound_cmds int,
    is_host_login int, is_guest_login int
"""
TRAFFIC_FIELDS = """
    count int, srv_count int, serror_rate double, srv_serror_rate double,
    rerror_rate double, srv_rerror_rate double, same_srv_rate double,
    diff_srv_rate double, srv_diff_host_rate double
"""
HOST_FIELDS = """
    dst_host_count int, dst_host_srv_count int, dst_host_same_srv_rate double,
    dst_host_diff_srv_rate double, dst_host_same_src_port_rate double,
    dst_host_srv_diff_host_rate double, dst_host_serror_rate double,
    dst_host_srv_serror_rate double, dst_host_rerror_rate double,
    dst_host_srv_rerror_rate double
"""
ADDED_FIELDS = "timestamp double, label string"

#: A message without one of these is "incomplete".
REQUIRED_FIELDS = ("timestamp", "protocol_type", "service", "flag", "label")

#: The class every other label is measured against.
NORMAL_LABEL = "normal"

#: Status of a usable record, and the two reserved counters that appear in the
#: label column of the counts table next to real classes.
VALID = "valid"
UNPARSEABLE = "__malformed_unparseable__"
INCOMPLETE = "__malformed_incomplete__"

#: Severities, least severe first.
SEVERITIES = ("low", "medium", "high", "critical")

#: Detection latency goal, seconds.
LATENCY_TARGET_SECONDS = 2.0

#: Time zone operators read the dashboards in.
DISPLAY_TIME_ZONE = "Asia/Ho_Chi_Minh"
# --- end of fixed values ----------------------------------------------------

_TYPES = {
    "double": DoubleType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "array<string>": ArrayType(StringType()),
    "binary": BinaryType(),
}


def _struct(declaration: str) -> StructType:
    """Nullable fields from "name type, ..." (needs no running session)."""
    pairs = (entry.split() for entry in declaration.split(","))
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


RECORD_SCHEMA = _struct(
    ",".join([BASIC_FIELDS, CONTENT_FIELDS, TRAFFIC_FIELDS, HOST_FIELDS, ADDED_FIELDS])
)
RECORD_FIELDS: list[str] = RECORD_SCHEMA.fieldNames()

#: Fields a rule may never read: ground truth.
FORBIDDEN_FIELDS = frozenset({"label"})

#: Columns the decoder adds.
STATUS_COLUMN = "_status"
COUNT_LABEL_COLUMN = "_count_label"

#: Columns rule evaluation adds.
VERDICT_SCHEMA = _struct(
    "matched_rule_ids array<string>, matched_attack_types array<string>, "
    "max_severity string, is_detection boolean"
)
VERDICT_FIELDS: list[str] = VERDICT_SCHEMA.fieldNames()


def detections_schema(record: StructType = RECORD_SCHEMA) -> StructType:
    """Schema of the detections table for any record schema."""
    stamp = _struct("batch_id bigint, processed_at timestamp, latency_seconds double")
    return StructType(record.fields + VERDICT_SCHEMA.fields + stamp.fields)


#: One row per (batch, label).
COUNTS_SCHEMA = _struct(
    "batch_id bigint, batch_time timestamp, label string, record_count bigint"
)

#: One row per batch: what it read and how long storing it took.
BATCHES_SCHEMA = _struct(
    "batch_id bigint, batch_time timestamp, messages bigint, valid bigint, unparseable bigint, "
    "incomplete bigint, batch_ms bigint"
)

#: What one batch adds to an alert; services are a set, latencies a sketch that can be merged.
ALERT_PARTS_SCHEMA = _struct(
    "batch_id bigint, batch_time timestamp, window_start_ts timestamp, verdict string, actual_label string, "
    "detected_as string, rules_fired string, max_severity string, event_count bigint, services array<string>, "
    "conn_min int, conn_max int, latency_sum double, latency_n bigint, latency_max double, latency_sketch binary"
)
