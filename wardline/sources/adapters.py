"""The given tables seen as labelled records.

``events`` becomes connection records, and those become JSON messages with
faults in them; ``lineitem`` and ``documents`` become labelled rows with other
schemas, since rules work on any schema.  All of it is plain column arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from wardline.operators.shipped_rules import shipped_rules
from wardline.schema import NORMAL_LABEL, RECORD_FIELDS, RECORD_SCHEMA

# --- fixed values: classes and categories of connection records -------------
ATTACK_TYPES = (
    "ddos", "port_scan", "brute_force", "malware_c2", "data_exfiltration", "malicious_download",
)
SERVICES = (
    "http", "ftp", "ftp_data", "smtp", "ssh", "telnet", "dns", "pop_3",
    "imap4", "https", "ntp_u", "private", "other", "domain_u", "finger",
)
# --- end of fixed values ----------------------------------------------------

#: Flags of connections (fixed values).
FLAGS = ("SF", "S0", "S1", "REJ", "RSTO", "RSTR", "SH", "OTH")

#: How an event becomes a record.  Fields no rule is about follow from the
#: event's own columns; the others do too, unless the event poses as a class.
TEXT_FIELDS = {
    "protocol_type": ("k", ("tcp", "udp", "icmp")),
    "service": ("k + user_id", SERVICES),
    "flag": ("user_id", FLAGS),
}
SIZES = {"duration": "value / 7", "src_bytes": "value * 60", "dst_bytes": "value * 45 + k"}
COUNTERS = ("count", "srv_count", "dst_host_count", "dst_host_srv_count")


def _plain(position: int, name: str) -> str:
    """A field of an event that poses as nothing: rates under a quarter, flags of zero or one."""
    if name in TEXT_FIELDS:
        source, words = TEXT_FIELDS[name]
        return f"split_part('{','.join(words)}', ',', CAST(({source}) % {len(words)} AS INT) + 1)"
    if name in SIZES:
        return SIZES[name]
    if name in COUNTERS:
        return f"20 + (user_id + {position} * k) % 80"
    if isinstance(RECORD_SCHEMA[name].dataType, DoubleType):
        return f"((k + {position} * user_id) % 100) / 400e0"
    return f"(k + {position}) % 2"


def _posed(op: str, bound: float | str) -> tuple[str, str]:
    """Values on the side of a rule's bound that fires, and on the other; ``k`` moves them about."""
    bound = f"{float(bound)!r}e0"
    over, under = f"{bound} + abs({bound}) * k / 200e0", f"{bound} - abs({bound}) * k / 200e0"
    beyond, below = f"{bound} + abs({bound}) * (k + 1) / 100e0 + 1", f"{bound} - abs({bound}) * (k + 1) / 200e0 - 1"
    return {
        ">=": (over, f"{bound} / 4e0"), "<=": (under, beyond), ">": (beyond, under), "<": (below, over),
        "==": (f"{bound}", below), "!=": (beyond, f"{bound}"),
    }[op]


def record_expression(field: str) -> str:
    """SQL text of one record field, typed as the record schema says.

    A rule's own conditions say what an event looks like that poses as its
    class: ``fires`` puts a field on the rule's side of the bound.
    """
    if field == "label":
        return "label"
    if field == "timestamp":
        return "epoch_seconds + CASE WHEN event_id % 101 = 7 THEN 75 WHEN event_id % 103 = 9 THEN -600 ELSE 0 END"
    text = _plain(RECORD_FIELDS.index(field), field)
    arms = ""
    for rule in shipped_rules():
        for condition in rule.conditions:
            if condition.field == field:
                yes, no = _posed(condition.op, condition.value)
                arms += f" WHEN pose = '{rule.attack_type}' THEN CASE WHEN fires THEN {yes} ELSE {no} END"
    if arms:
        text = f"CASE{arms} ELSE {text} END"
    kind = RECORD_SCHEMA[field].dataType
    if isinstance(kind, IntegerType):
        return f"CAST(floor({text}) AS INT)"
    if isinstance(kind, DoubleType):
        return f"CAST({text} AS DOUBLE)"
    return text


#: SQL texts shared by both sides.  One event in twenty is an attack; one in
#: eighty claims a class made of underscores, one in 307 a reserved one.
KIND = f"split_part('{','.join(ATTACK_TYPES)}', ',', CAST(event_id / 20 AS INT) % {len(ATTACK_TYPES)} + 1)"
LABEL = (
    f"CASE WHEN event_id % 20 = 19 THEN {KIND} WHEN event_id % 307 = 11 THEN '__odd__' "
    f"WHEN event_id % 80 = 42 THEN '__half' ELSE '{NORMAL_LABEL}' END"
)
#: Some attacks pose as the next kind, some other events as an attack.
NEXT_KIND = f"split_part('{','.join(ATTACK_TYPES)}', ',', CAST(event_id / 20 + 1 AS INT) % {len(ATTACK_TYPES)} + 1)"
POSE = (
    f"CASE WHEN event_id % 20 = 19 AND user_id % 13 = 0 THEN {NEXT_KIND} "
    f"WHEN event_id % 20 = 19 OR event_id % 61 = 0 THEN {KIND} ELSE 'none' END"
)
FIRES = "k < 92"

#: Records replay the events this many times faster, from this instant on.
SPEED, ORIGIN_MICROS = 720, 1_704_067_200_000_000


# --- events -----------------------------------------------------------------

EVENT_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("user_id", LongType()),
    StructField("value", DoubleType()), StructField("k", IntegerType()),
    StructField("hour", IntegerType()), StructField("event_type", StringType()),
    StructField("label", StringType()),
])
#: The class comes from the event type, so rules may read neither.
EVENT_FORBIDDEN = frozenset({"label", "event_type"})


def event_view(events: DataFrame) -> DataFrame:
    """Events with an error/purchase/normal class and a minute batch clock.

    A micro-batch is a minute: its id is the epoch minute, and it is processed
    the moment the minute ends.
    """
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        "user_id",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.hour(ts).alias("hour"),
        "event_type",
        F.when(F.col("event_type").isin("error", "purchase"), F.col("event_type"))
        .otherwise(NORMAL_LABEL)
        .alias("label"),
        ts.alias("ts"),
        F.floor(F.unix_micros(ts) / F.lit(60_000_000)).alias("batch_id"),
        (F.date_trunc("minute", ts) + F.make_dt_interval(mins=F.lit(1))).alias("processed_at"),
    )


def record_view(events: DataFrame, fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """Events as connection records: one in twenty an attack, six kinds in turn.

    A micro-batch is a minute of the replay: its id is the epoch minute, and it
    is processed the moment the minute ends.  The record goes through ``inline``
    so that a filter on its fields does not repeat their expressions; name the
    ``fields`` needed, as nothing prunes them.
    """
    micros = F.floor((F.unix_micros("ts") - ORIGIN_MICROS) / SPEED) + ORIGIN_MICROS
    minute = F.floor(micros / F.lit(60_000_000))
    base = event_view(events).select(
        "event_id", "user_id", "value", "k",
        minute.alias("batch_id"),
        F.timestamp_micros((minute + 1) * 60_000_000).alias("processed_at"),
        (micros / F.lit(1e6)).alias("epoch_seconds"),
        F.expr(LABEL).alias("label"),
        F.expr(POSE).alias("pose"),
        F.expr(FIRES).alias("fires"),
    )
    record = ", ".join(f"{record_expression(name)} AS `{name}`" for name in fields)
    return base.selectExpr("event_id", "batch_id", "processed_at", f"inline(array(struct({record})))")


#: Faults by event id: every 97th message is cut short, every 89th of the
#: others loses its label, every 83rd carries text where a number belongs.
CUT_EVERY, UNLABELLED_EVERY, MISTYPED_EVERY = 97, 89, 83


MESSAGE_TABLE = StructType([
    StructField("event_id", LongType()), StructField("batch_id", LongType()),
    StructField("processed_at", TimestampType()), StructField("value", StringType()),
])


def message_view(events: DataFrame) -> DataFrame:
    """Records as JSON text in a ``value`` column, with transport faults."""
    records = record_view(events)
    event_id = F.col("event_id")
    fields = ", ".join(f"`{name}`" for name in RECORD_FIELDS if name != "label")
    label = f"CASE WHEN event_id % {UNLABELLED_EVERY} <> 0 THEN label END AS label"
    text = F.expr(f"to_json(struct({fields}, {label}))")
    text = F.when(
        event_id % MISTYPED_EVERY == 0,
        F.regexp_replace(text, '"count":[0-9]+', '"count":"many"'),
    ).otherwise(text)
    value = F.when(event_id % CUT_EVERY == 0, F.left(text, F.length(text) - 10)).otherwise(text)
    return records.select("event_id", "batch_id", "processed_at", value.alias("value"))


# --- other tables -----------------------------------------------------------

LINE_SCHEMA = StructType([
    StructField("l_quantity", DoubleType()), StructField("l_extendedprice", DoubleType()),
    StructField("l_discount", DoubleType()), StructField("l_tax", DoubleType()),
    StructField("l_linenumber", IntegerType()), StructField("l_linestatus", StringType()),
    StructField("label", StringType()),
])


def line_view(lineitem: DataFrame) -> DataFrame:
    """Order lines; a returned or accepted line is the class to find."""
    return lineitem.select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_linestatus",
        F.when(F.col("l_returnflag") == "N", NORMAL_LABEL).otherwise(F.col("l_returnflag")).alias("label"),
    )


DOCUMENT_SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("n_chars", LongType()),
    StructField("lang", StringType()), StructField("source", StringType()),
    StructField("label", StringType()),
])


def document_view(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with their class from a second table; unlabelled ones drop out."""
    truth = labels.select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise(NORMAL_LABEL).alias("label")
    )
    return documents.select("doc_id", "n_chars", "lang", "source").join(truth, "doc_id")
