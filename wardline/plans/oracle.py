"""For each query the same result in plain SQL on the given tables.

The SQL never looks at JSON: it knows from the event id which message was
damaged, and tests the rules by hand-written predicates.  Only the arithmetic
that turns an event into a record is shared with the Spark side.
"""

from __future__ import annotations

from wardline.schema import INCOMPLETE, RECORD_FIELDS, UNPARSEABLE, VALID
from wardline.sources.adapters import (
    CUT_EVERY,
    FIRES,
    LABEL,
    MISTYPED_EVERY,
    ORIGIN_MICROS,
    POSE,
    SPEED,
    UNLABELLED_EVERY,
    record_expression,
)


def _duck(expression: str) -> str:
    """A shared expression in DuckDB's words, where a cast to an integer would round."""
    return expression.replace("CAST(event_id / 20", "CAST(event_id // 20")


_EV = """
ev AS (
  SELECT event_id, user_id, value, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k,
         CAST(hour(ts) AS INT) AS hour,
         CASE WHEN event_type IN ('error', 'purchase') THEN event_type ELSE 'normal' END AS label,
         ts, CAST(epoch_us(ts) // 60000000 AS BIGINT) AS batch_id,
         date_trunc('minute', ts) + INTERVAL 1 MINUTE AS processed_at
  FROM events
)"""

_EVJ = _EV + """,
evj AS (
  SELECT *, r1 OR r2 OR r3 AS flagged,
         concat_ws(', ', CASE WHEN r1 THEN 'large_and_late' END,
                         CASE WHEN r2 THEN 'small_watched' END,
                         CASE WHEN r3 THEN 'middling_late' END) AS rules_fired,
         -- rules 1 and 3 both claim 'error'; first claim decides the place
         concat_ws(', ', CASE WHEN r1 THEN 'error' END, CASE WHEN r2 THEN 'purchase' END,
                         CASE WHEN r3 AND NOT r1 THEN 'error' END) AS detected_as
  FROM (SELECT *, value >= 80 AND k >= 30 AS r1,
               value <= 5 AND user_id IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89) AS r2,
               k >= 60 AND value >= 40 AS r3
        FROM ev)
)"""

_REC = _EV + f""",
timed AS (
  SELECT *, CAST(floor((epoch_us(ts) - {ORIGIN_MICROS}) / {SPEED}) AS BIGINT) + {ORIGIN_MICROS} AS micros
  FROM ev
),
base AS (
  SELECT event_id, user_id, value, k, micros // 60000000 AS batch_id,
         make_timestamp((micros // 60000000 + 1) * 60000000) AS processed_at, micros / 1e6 AS epoch_seconds,
         {_duck(LABEL)} AS label, {_duck(POSE)} AS pose, {FIRES} AS fires
  FROM timed
),
rec AS (
  SELECT event_id, batch_id, processed_at,
         {", ".join(f'{record_expression(name)} AS "{name}"' for name in RECORD_FIELDS)}
  FROM base
)"""


def _judged(name: str, source: str, last: str = "true") -> str:
    """The shipped rules over ``source``; a null comparison is no match.  ``last`` can switch the last rule off."""
    return f"""
{name} AS (
  SELECT *, r1 OR r2 OR r3 OR r4 OR r5 OR r6 AS flagged,
         concat_ws(', ', CASE WHEN r1 THEN 'ddos_flood' END, CASE WHEN r2 THEN 'port_scan_sweep' END,
                   CASE WHEN r3 THEN 'brute_force_login' END, CASE WHEN r4 THEN 'malware_c2_beacon' END,
                   CASE WHEN r5 THEN 'data_exfiltration_outbound' END,
                   CASE WHEN r6 THEN 'malicious_download_inbound' END) AS rules_fired,
         concat_ws(', ', CASE WHEN r1 THEN 'ddos' END, CASE WHEN r2 THEN 'port_scan' END,
                   CASE WHEN r3 THEN 'brute_force' END, CASE WHEN r4 THEN 'malware_c2' END,
                   CASE WHEN r5 THEN 'data_exfiltration' END,
                   CASE WHEN r6 THEN 'malicious_download' END) AS detected_as,
         CASE WHEN r1 OR r5 THEN 'critical' WHEN r3 OR r4 OR r6 THEN 'high'
              WHEN r2 THEN 'medium' END AS max_severity
  FROM (
    SELECT *,
      coalesce("count" >= 150 AND serror_rate >= 0.7e0 AND dst_bytes <= 20, false) AS r1,
      coalesce(diff_srv_rate >= 0.5e0 AND same_srv_rate <= 0.15e0 AND rerror_rate >= 0.4e0, false) AS r2,
      coalesce(num_failed_logins >= 2 AND "count" >= 15, false) AS r3,
      coalesce("count" <= 8 AND dst_host_count <= 15 AND dst_host_srv_count <= 15
               AND same_srv_rate >= 0.85e0, false) AS r4,
      coalesce(src_bytes >= 50000 AND dst_bytes <= 1000 AND logged_in = 1, false) AS r5,
      coalesce(dst_bytes >= 65000 AND src_bytes <= 500, false) AND {last} AS r6
    FROM {source})
)"""


_RECJ = _REC + "," + _judged("recj", "rec")

_KEPT = ", ".join(
    f"CASE WHEN status = '{UNPARSEABLE}' THEN NULL ELSE "
    + {
        "label": f"CASE WHEN status = '{INCOMPLETE}' THEN NULL ELSE label END",
        "count": f'CASE WHEN event_id % {MISTYPED_EVERY} = 0 THEN NULL ELSE "count" END',
    }.get(name, f'"{name}"')
    + f' END AS "{name}"'
    for name in RECORD_FIELDS
)

_MSG = _REC + f""",
msg AS (
  SELECT event_id, batch_id, processed_at, status,
         CASE WHEN status = '{VALID}' THEN label ELSE status END AS count_label, {_KEPT}
  FROM (SELECT *, CASE WHEN event_id % {CUT_EVERY} = 0 THEN '{UNPARSEABLE}'
                       WHEN event_id % {UNLABELLED_EVERY} = 0 THEN '{INCOMPLETE}'
                       ELSE '{VALID}' END AS status
        FROM rec)
)"""

_CNT = _MSG + """,
cnt AS (
  SELECT batch_id, processed_at AS batch_time, count_label AS label, count(*) AS record_count
  FROM msg GROUP BY ALL
)"""

_DET = _CNT + "," + _judged("msgj", "msg") + """,
det AS (
  SELECT *, epoch_us(processed_at) / 1e6 - "timestamp" AS latency_seconds
  FROM msgj WHERE status = 'valid' AND (label <> 'normal' OR flagged)
)"""

_CLAIMS = """
claims AS (
  SELECT label, unnest(string_split(detected_as, ', ')) AS attack_type FROM det WHERE detected_as <> ''
)"""

_REAL = r"label NOT LIKE '\_\_%\_\_' ESCAPE '\'"
_ZONE = "INTERVAL 7 HOUR"


def _n(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def _cases(true_positive: str, missed: str, false_positive: str) -> str:
    return ", ".join(
        [
            _n("count(*) FILTER (WHERE label <> 'normal' AND flagged)", true_positive),
            _n("count(*) FILTER (WHERE label <> 'normal' AND NOT flagged)", missed),
            _n("count(*) FILTER (WHERE label = 'normal' AND flagged)", false_positive),
        ]
    )


def _verdict(types: str = "detected_as") -> str:
    return f"""CASE WHEN label = 'normal' AND flagged THEN 'FALSE POSITIVE'
         WHEN label <> 'normal' AND NOT flagged THEN 'MISSED'
         WHEN label <> 'normal' AND list_contains(string_split({types}, ', '), label) THEN 'CORRECT'
         WHEN label <> 'normal' AND flagged THEN 'WRONG TYPE' ELSE 'unclassified' END"""


_RANK = """CASE WHEN label = 'normal' AND flagged THEN 0
                WHEN label <> 'normal' AND NOT flagged THEN 1 ELSE 2 END"""

_SECOND = "make_timestamp(CAST(floor(\"timestamp\") AS BIGINT) * 1000000)"
_MINUTE = f"date_trunc('minute', {_SECOND})"


def _text(instant: str, pattern: str = "%Y-%m-%d %H:%M:%S") -> str:
    return f"strftime({instant}, '{pattern}')"


def _confusion(suffix: str = "") -> str:
    """CTEs m(tp, fn, fp, normal_total, total_records) from det and cnt tables."""
    return f"""
m{suffix} AS (
  SELECT {_cases("tp", "fn", "fp")},
         (SELECT CAST(coalesce(sum(record_count), 0) AS BIGINT) FROM cnt{suffix} WHERE label = 'normal') AS normal_total,
         (SELECT CAST(coalesce(sum(record_count), 0) AS BIGINT) FROM cnt{suffix} WHERE {_REAL}) AS total_records
  FROM det{suffix}
)"""


_RATES = """
tp / nullif(tp + fp, 0)::DOUBLE AS "precision", tp / nullif(tp + fn, 0)::DOUBLE AS recall,
fp / nullif(normal_total, 0)::DOUBLE AS false_positive_rate,
(tp + normal_total - fp) / nullif(total_records, 0)::DOUBLE AS accuracy"""

_F1 = """CASE WHEN "precision" <> 0 AND recall <> 0
              THEN 2 * "precision" * recall / ("precision" + recall) END AS f1"""


def _label_rows(suffix: str = "") -> str:
    return f"""
traffic{suffix} AS (
  SELECT label, sum(record_count) AS traffic FROM cnt{suffix} WHERE {_REAL} GROUP BY label
),
lab{suffix} AS (
  SELECT *, caught / nullif(stored, 0)::DOUBLE AS recall,
         correct / nullif(predicted, 0)::DOUBLE AS "precision"
  FROM (
    SELECT coalesce(o.label, a.label) AS label,
           {_n("coalesce(t.traffic, o.stored, 0)", "support")},
           {_n("coalesce(o.stored, 0)", "stored")}, {_n("coalesce(o.caught, 0)", "caught")},
           {_n("coalesce(a.predicted, 0)", "predicted")}, {_n("coalesce(a.correct, 0)", "correct")},
           {_n("coalesce(o.stored, 0) - coalesce(o.caught, 0)", "missed")}
    FROM (SELECT label, count(*) AS stored, count(*) FILTER (WHERE flagged) AS caught
          FROM det{suffix} WHERE label <> 'normal' GROUP BY label) o
    FULL OUTER JOIN (
          SELECT attack_type AS label, count(*) AS predicted,
                 count(*) FILTER (WHERE label = attack_type) AS correct
          FROM claims{suffix} GROUP BY attack_type) a ON o.label = a.label
    LEFT JOIN traffic{suffix} t ON t.label = coalesce(o.label, a.label))
)"""


def _long(suffix: str = "") -> str:
    overall = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, '*' AS label, \"{m}\" AS value FROM rates{suffix}"
        for m in ("precision", "recall", "f1", "false_positive_rate", "accuracy")
    )
    labels = " UNION ALL ".join(
        f"SELECT '{m}', label, \"{m}\" FROM (SELECT *, {_F1} FROM lab{suffix})"
        for m in ("precision", "recall", "f1")
    )
    return f"""
rates{suffix} AS (SELECT *, {_F1} FROM (SELECT *, {_RATES} FROM m{suffix})),
long{suffix} AS ({overall} UNION ALL {labels})"""


_ALERTS = f"""
alerts AS (
  SELECT {_text(f"{_MINUTE} + {_ZONE}", "%Y-%m-%d %H:%M")} AS window_start,
         {_text(_MINUTE)} AS window_start_ts, {_verdict()} AS verdict, label AS actual_label,
         detected_as, rules_fired, max_severity, {_n("count(*)", "event_count")},
         {_n("count(DISTINCT service)", "services_touched")},
         min("count") AS conn_min, max("count") AS conn_max,
         round(avg(latency_seconds), 2) AS avg_latency_s, {_RANK} AS problem_rank
  FROM det GROUP BY ALL
)"""

_RAW = f"""
raw AS (
  SELECT "timestamp", {_text(f"{_SECOND} + {_ZONE}")} AS event_time,
         {_text(f"{_MINUTE} + {_ZONE}", "%Y-%m-%d %H:%M")} AS window_start,
         {_text(_SECOND)} AS event_ts, label AS actual_label, detected_as, rules_fired,
         max_severity, {_verdict()} AS verdict, protocol_type, service, src_bytes, dst_bytes,
         "count" AS connection_count, round(latency_seconds, 3) AS latency_s,
         {_RANK} AS problem_rank
  FROM det
)"""


def _quantile(p: float, places: int, name: str) -> str:
    return f"round(quantile_cont(latency_seconds, {p}), {places}) AS {name}"


def _check(name: str, passed: str, expected: str, actual: str, label: str = "CAST(NULL AS VARCHAR)") -> str:
    return (
        f"SELECT '{name}' AS check_name, {label} AS label, {passed} AS passed, "
        f"round(CAST({expected} AS DOUBLE), 6) AS expected, round(CAST({actual} AS DOUBLE), 6) AS actual"
    )


def _counts_query(body: str) -> str:
    return f"WITH {_CNT} {body}"


def _det_query(body: str, *more: str) -> str:
    return f"WITH {','.join([_DET, *more])} {body}"


_DET_COLUMNS = ", ".join(f'"{name}"' for name in RECORD_FIELDS)

_ROUND_TRIP = _det_query(
    """SELECT label, count(*) AS written, count(*) AS read_back, true AS same_values, true AS same_types
       FROM det GROUP BY label"""
)

_RUNS = _MSG + """,
cnt AS (
  SELECT 'a' AS run_id, CASE WHEN minute(processed_at) < 30 THEN 0 ELSE 1 END AS batch_id, count_label AS label,
         CASE WHEN minute(processed_at) < 30 THEN TIMESTAMP '2024-01-30 12:00:00'
              ELSE TIMESTAMP '2024-01-31 12:00:00' END AS batch_time, count(*) AS record_count
  FROM msg GROUP BY ALL
  UNION ALL
  SELECT 'b', 0, count_label, TIMESTAMP '2024-02-01 12:00:00', count(*) FROM msg GROUP BY ALL
)"""


#: Detections as the first of the two stored runs has them.
_RUN_DET = """run_det AS (
  SELECT * EXCLUDE (seen_at) REPLACE (seen_at AS processed_at, epoch(seen_at) - "timestamp" AS latency_seconds) FROM (
    SELECT *, CASE WHEN minute(processed_at) < 30 THEN TIMESTAMP '2024-01-30 12:00:00'
                   ELSE TIMESTAMP '2024-01-31 12:00:00' END AS seen_at FROM det)
)"""


def _cells(part: str, source: str, figures: str, item: str = "''") -> str:
    """One row per figure of a report part."""
    return " UNION ALL ".join(
        f"SELECT '{part}' AS part, {item} AS item, '{name}' AS figure, round(CAST(\"{name}\" AS DOUBLE), 6) AS value FROM {source}"
        for name in figures.split()
    )


def _health(key: str = "batch_id") -> str:
    return f"""
health AS (
  SELECT {key},
    {_n(f"coalesce(sum(record_count) FILTER (WHERE label NOT IN ('{UNPARSEABLE}', '{INCOMPLETE}')), 0)", "valid")},
    {_n(f"coalesce(sum(record_count) FILTER (WHERE label = '{UNPARSEABLE}'), 0)", "unparseable")},
    {_n(f"coalesce(sum(record_count) FILTER (WHERE label = '{INCOMPLETE}'), 0)", "incomplete")},
    {_n("sum(record_count)", "messages")}
  FROM cnt GROUP BY {key}
)"""


def _hits(source: str, tests: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule_id, count(*) AS matches FROM {source} WHERE {test} HAVING count(*) > 0"
        for name, test in tests.items()
    )


_CHECKS = " UNION ALL ".join([
            _check("stored_matches_traffic", "coalesce(t.n, 0) = coalesce(d.n, 0)", "coalesce(t.n, 0)",
                   "coalesce(d.n, 0)", "coalesce(t.label, d.label)")
            + f""" FROM (SELECT label, sum(record_count) AS n FROM cnt WHERE {_REAL} AND label <> 'normal'
                         GROUP BY label) t
                   FULL OUTER JOIN (SELECT label, count(*) AS n FROM det WHERE label <> 'normal' GROUP BY label) d
                   ON t.label = d.label""",
            _check("false_positives_within_normal", "fp <= normal_total", "normal_total", "fp") + " FROM m",
            _check("latency_not_negative", "max(latency_seconds) >= 0", "0", "max(latency_seconds)") + " FROM det",
            _check("no_clock_skew", "min(latency_seconds) >= 0", "0", "min(latency_seconds)") + " FROM det",
            _check("no_reserved_label_stored", "count(*) = 0", "0", "count(*)") + f" FROM det WHERE NOT ({_REAL})",
])


ORACLE: dict[str, str] = {
    "rule_ops": f"WITH {_EV} "
    + _hits("ev", {
        "gt": "k > 70", "ge": "k >= 70", "lt": "value < 12.5", "le": "k <= 20",
        "eq_number": "k = 42", "ne_number": "k <> 42",
        "in_number": "hour IN (0, 12, 23)", "not_in_number": "hour NOT IN (0, 12, 23)",
    })
    + " UNION ALL "
    + _hits("documents", {
        "eq_text": "lang = 'en'", "ne_text": "lang <> 'en'",
        "in_text": "lang IN ('de', 'fr')", "not_in_text": "lang NOT IN ('de', 'fr')",
    }),
    "rule_nulls": f"""WITH {_EV},
      sparse AS (SELECT CASE WHEN k >= 20 THEN k END AS k, CASE WHEN hour >= 6 THEN value END AS value FROM ev),
      j AS (SELECT *, k IS NOT NULL AND k <> 10 AS a, k IS NOT NULL AND k NOT IN (1, 2, 3) AS b,
                   k IS NOT NULL AND value IS NOT NULL AND k <= 50 AND value >= 1 AS c FROM sparse)
      SELECT k IS NULL AS k_null, value IS NULL AS value_null,
             concat_ws(', ', CASE WHEN a THEN 'not_ten' END, CASE WHEN b THEN 'not_listed' END,
                       CASE WHEN c THEN 'small' END) AS rules_fired,
             CASE WHEN c THEN 'high' WHEN b THEN 'medium' WHEN a THEN 'low' END AS max_severity,
             a OR b OR c AS is_detection, count(*) AS events
      FROM j GROUP BY ALL""",
    "rules_empty": """SELECT count(*) AS events, count(*) AS no_rules, count(*) AS no_types,
      count(*) AS no_severity, CAST(0 AS BIGINT) AS detections FROM events""",
    "rules_evaluate": f"""WITH {_RECJ} SELECT event_id, label, rules_fired AS matched_rule_ids,
      detected_as AS matched_attack_types, max_severity, flagged AS is_detection FROM recj""",
    "line_outcomes": """WITH j AS (
        SELECT CASE WHEN l_returnflag = 'N' THEN 'normal' ELSE l_returnflag END AS label,
          l_quantity >= 45 AND l_discount >= 0.08e0 AND l_tax <= 0.02e0 AS a1,
          l_quantity <= 5 AND l_extendedprice <= 5000 AND l_tax >= 0.06e0 AS a2,
          l_linestatus = 'O' AND l_linenumber >= 6 AS a3,
          l_extendedprice >= 60000 AND l_tax <= 0.01e0 AND l_discount <= 0.01e0 AND l_quantity >= 30 AS a4,
          l_linenumber = 1 AND l_discount >= 0.09e0 AND l_quantity <= 10 AS a5,
          l_linestatus = 'F' AND l_discount <= 0 AS a6
        FROM lineitem)
      SELECT label,
        CASE WHEN a1 AND (a2 OR a3 OR a5) THEN 'A, R'
             WHEN (a2 OR a3) AND (a1 OR a4 OR a6) THEN 'R, A'
             WHEN a5 AND a4 THEN 'A, R' WHEN a5 AND a6 THEN 'R, A'
             WHEN a1 OR a4 OR a6 THEN 'A' WHEN a2 OR a3 OR a5 THEN 'R' ELSE '' END AS detected_as,
        CASE WHEN a1 OR a5 THEN 'critical' WHEN a3 OR a4 THEN 'high' WHEN a2 THEN 'medium'
             WHEN a6 THEN 'low' END AS max_severity,
        count(*) AS lines
      FROM j GROUP BY ALL""",
    "document_outcomes": f"""SELECT label, count(*) AS stored,
      {_n("count(*) FILTER (WHERE n_chars < 400 OR (n_chars > 5000 AND lang <> 'en'))", "caught")}
      FROM (SELECT n_chars, lang, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'normal' END AS label
            FROM documents JOIN labels USING (doc_id)) GROUP BY label""",
    "parse_classify": f"""WITH {_MSG} SELECT event_id, {_DET_COLUMNS}, status AS _status,
      count_label AS _count_label FROM msg""",
    "fields_present": f"""WITH {_MSG} SELECT event_id, CASE WHEN status = '{UNPARSEABLE}' THEN 0 ELSE
      {len(RECORD_FIELDS)} - (status = '{INCOMPLETE}')::INT - (event_id % {MISTYPED_EVERY} = 0)::INT
      END::BIGINT AS fields_present FROM msg""",
    "counts_per_batch": _counts_query(
        f"SELECT batch_id, {_text('batch_time')} AS batch_time, label, record_count FROM cnt"
    ),
    "detections": _det_query(
        f"""SELECT {_DET_COLUMNS}, rules_fired AS matched_rule_ids, detected_as AS matched_attack_types,
        max_severity, flagged AS is_detection, batch_id, {_text("processed_at")} AS processed_at,
        latency_seconds FROM det"""
    ),
    "latency_stamp": _det_query(
        f"""SELECT "timestamp", batch_id, {_text("processed_at")} AS processed_at, latency_seconds FROM det"""
    ),
    "outcome_per_label": _det_query(
        f"""SELECT label, count(*) AS stored, {_n("count(*) FILTER (WHERE flagged)", "caught")}
        FROM det GROUP BY label"""
    ),
    "attribution": _det_query(
        f"""SELECT attack_type, count(*) AS predicted,
        {_n("count(*) FILTER (WHERE label = attack_type)", "correct")} FROM claims GROUP BY attack_type""",
        _CLAIMS,
    ),
    "traffic_totals": _counts_query(
        f"SELECT label, {_n('sum(record_count)', 'total')} FROM cnt WHERE {_REAL} GROUP BY label"
    ),
    "malformed_totals": _counts_query(
        f"SELECT label, {_n('sum(record_count)', 'total')} FROM cnt WHERE NOT ({_REAL}) GROUP BY label"
    ),
    "malformed_rate": _counts_query(
        f"""SELECT *, malformed_total / nullif(messages, 0)::DOUBLE AS malformed_rate FROM (
        SELECT {_n(f"coalesce(sum(record_count) FILTER (WHERE NOT ({_REAL})), 0)", "malformed_total")},
        {_n("sum(record_count)", "messages")} FROM cnt)"""
    ),
    "latency_summary": _det_query(
        f"""SELECT *, under_target / nullif(n, 0)::DOUBLE AS under_target_pct FROM (
        SELECT count(*) AS n, round(avg(latency_seconds), 6) AS mean, {_quantile(0.5, 6, "p50")},
        {_quantile(0.95, 6, "p95")}, {_quantile(0.99, 6, "p99")}, round(max(latency_seconds), 6) AS "max",
        round(min(latency_seconds), 6) AS "min",
        {_n("count(*) FILTER (WHERE latency_seconds < 2)", "under_target")} FROM det)"""
    ),
    "batch_window": _counts_query(
        f"""SELECT count(DISTINCT batch_id) AS batches, {_text("min(batch_time)")} AS first_seen,
        {_text("max(batch_time)")} AS last_seen FROM cnt"""
    ),
    "confusion": _det_query(
        """SELECT tp, fn, fp, normal_total - fp AS tn, normal_total,
        total_records - normal_total AS attack_total, total_records FROM m""",
        _confusion(),
    ),
    "overall_metrics": _det_query(
        f"""SELECT *, {_F1} FROM (SELECT tp, fn, fp, normal_total - fp AS tn, normal_total,
        total_records - normal_total AS attack_total, total_records, {_RATES} FROM m)""",
        _confusion(),
    ),
    "label_metrics": _det_query(f"SELECT *, {_F1} FROM lab", _CLAIMS, _label_rows()),
    "integrity": _det_query(_CHECKS, _confusion()),
    "table_counts": _det_query(
        """SELECT 'detections' AS table_name, count(*) AS row_count FROM det
        UNION ALL SELECT 'traffic_counts', count(*) FROM cnt"""
    ),
    "storage_ratio": _det_query(
        """SELECT *, stored_rows / nullif(ingested, 0)::DOUBLE AS storage_ratio FROM (
        SELECT count(*) AS stored_rows, (SELECT CAST(sum(record_count) AS BIGINT) FROM cnt) AS ingested FROM det)"""
    ),
    "baseline_accuracy": _det_query(
        f"""SELECT accuracy, baseline_accuracy, round(accuracy - baseline_accuracy, 6) AS lift FROM (
        SELECT {_RATES}, normal_total / nullif(total_records, 0)::DOUBLE AS baseline_accuracy FROM m)""",
        _confusion(),
    ),
    "class_mix": _counts_query(
        f"""SELECT label, records, records / (SELECT sum(record_count) FROM cnt WHERE {_REAL})::DOUBLE AS share
        FROM (SELECT label, {_n("sum(record_count)", "records")} FROM cnt WHERE {_REAL} GROUP BY label)"""
    ),
    "fp_by_rule": _det_query(
        """SELECT rule_id, count(*) AS false_positives,
        count(*) / (SELECT sum(record_count) FROM cnt WHERE label = 'normal')::DOUBLE AS rate
        FROM (SELECT unnest(string_split(rules_fired, ', ')) AS rule_id FROM det WHERE label = 'normal')
        GROUP BY rule_id"""
    ),
    "runs_batch_window": f"""WITH {_RUNS} SELECT count(DISTINCT (run_id, batch_id)) AS batches,
      {_text("min(batch_time)")} AS first_seen, {_text("max(batch_time)")} AS last_seen FROM cnt""",
    "runs_batch_health": f"""WITH {_RUNS}, {_health("run_id, batch_id")} SELECT *,
      round(100 * ((unparseable + incomplete) / messages::DOUBLE), 6) AS malformed_pct FROM health""",
    "runs_malformed_running": f"""WITH {_RUNS}, {_health("run_id, batch_id")}
      SELECT run_id, batch_id, unparseable, incomplete,
      {_n("sum(unparseable) OVER (PARTITION BY run_id ORDER BY batch_id)", "unparseable_so_far")},
      {_n("sum(incomplete) OVER (PARTITION BY run_id ORDER BY batch_id)", "incomplete_so_far")} FROM health""",
    "run_compare": _det_query(
        """SELECT coalesce(a.metric, b.metric) AS metric, coalesce(a.label, b.label) AS label,
        round(a.value, 6) AS left_value, round(b.value, 6) AS right_value,
        round(b.value - a.value, 6) AS delta
        FROM long a FULL OUTER JOIN long_b b ON a.metric = b.metric AND a.label = b.label""",
        _CLAIMS, _confusion(), _label_rows(), _long(), _judged("msgj_b", "msg", "false"),
        "det_b AS (SELECT * FROM msgj_b WHERE status = 'valid' AND (label <> 'normal' OR flagged))",
        "cnt_b AS (SELECT * FROM cnt)",
        """claims_b AS (SELECT label, unnest(string_split(detected_as, ', ')) AS attack_type
           FROM det_b WHERE detected_as <> '')""",
        _confusion("_b"), _label_rows("_b"), _long("_b"),
    ),
    "offline_score": f"""WITH {_RECJ} SELECT *, caught / total::DOUBLE AS recall FROM (
      SELECT label, count(*) AS total, {_n("count(*) FILTER (WHERE flagged)", "caught")}
      FROM recj WHERE label <> 'normal' GROUP BY label)""",
    "offline_fp_rate": f"""WITH {_RECJ} SELECT *, false_positives / nullif(normal_total, 0)::DOUBLE
      AS false_positive_rate FROM (
      SELECT {_n("count(*)", "normal_total")}, {_n("count(*) FILTER (WHERE flagged)", "false_positives")}
      FROM recj WHERE label = 'normal')""",
    "attribution_mismatch": f"""WITH {_EVJ} SELECT count(*) AS mismatches FROM evj
      WHERE label <> 'normal' AND flagged AND NOT list_contains(string_split(detected_as, ', '), label)""",
    "verdicts": f"""WITH {_EVJ} SELECT event_id, label, detected_as, {_verdict()} AS verdict,
      {_RANK} AS problem_rank FROM evj""",
    "volume_kpis": _det_query(
        f"""SELECT
        (SELECT CAST(sum(record_count) FILTER (WHERE label <> 'normal') AS BIGINT) FROM cnt
         WHERE NOT starts_with(label, '__')) AS attack_records,
        (SELECT CAST(sum(record_count) AS BIGINT) FROM cnt WHERE NOT starts_with(label, '__')) AS total_records,
        {_cases("true_positives", "missed", "false_positives")} FROM det"""
    ),
    "accuracy_kpis": _det_query(
        """SELECT tp / nullif(tp + fn, 0)::DOUBLE AS recall, tp / nullif(tp + fp, 0)::DOUBLE AS "precision",
        fp / nullif(normal_total, 0)::DOUBLE AS false_positive_rate FROM m""",
        _confusion(),
    ),
    "alerts": _det_query("SELECT * FROM alerts", _ALERTS),
    "stream_alerts": _det_query("SELECT * FROM alerts", _ALERTS),
    "stream_batches": _counts_query(
        f"""SELECT {_n("sum(record_count)", "messages")},
        {_n("sum(record_count) FILTER (WHERE label NOT IN ('" + UNPARSEABLE + "', '" + INCOMPLETE + "'))", "valid")},
        {_n("sum(record_count) FILTER (WHERE label = '" + UNPARSEABLE + "')", "unparseable")},
        {_n("sum(record_count) FILTER (WHERE label = '" + INCOMPLETE + "')", "incomplete")},
        true AS batches_bounded, true AS cost_known FROM cnt"""
    ),
    "alerts_top": _det_query(
        """SELECT * FROM alerts ORDER BY window_start_ts DESC, problem_rank, event_count DESC, actual_label,
        detected_as, rules_fired, max_severity NULLS FIRST, verdict LIMIT 100""",
        _ALERTS,
    ),
    "alerts_false_positive": _det_query("SELECT * FROM alerts WHERE verdict = 'FALSE POSITIVE'", _ALERTS),
    "alert_raw": _det_query(
        """SELECT * FROM raw ORDER BY event_ts DESC, problem_rank, "timestamp", actual_label, service,
        src_bytes, dst_bytes LIMIT 500""",
        _RAW,
    ),
    "alert_drilldown": _det_query(
        """SELECT * FROM raw WHERE window_start IN
        (SELECT window_start FROM alerts WHERE verdict = 'FALSE POSITIVE')""",
        _ALERTS, _RAW,
    ),
    "recall_by_type": _det_query(
        f"""SELECT *, round(100 * (caught / seen::DOUBLE), 1) AS recall_pct FROM (
        SELECT label AS attack_type, count(*) AS seen, {_n("count(*) FILTER (WHERE flagged)", "caught")},
        {_n("count(*) FILTER (WHERE NOT flagged)", "missed")} FROM det WHERE label <> 'normal' GROUP BY label)"""
    ),
    "precision_by_type": _det_query(
        f"""SELECT *, round(100 * (correct / times_claimed::DOUBLE), 1) AS precision_pct FROM (
        SELECT attack_type, count(*) AS times_claimed,
        {_n("count(*) FILTER (WHERE label = attack_type)", "correct")} FROM claims GROUP BY attack_type)""",
        _CLAIMS,
    ),
    "latency_over_time": _det_query(
        f"""SELECT {_text("date_trunc('minute', processed_at)")} AS "minute", {_quantile(0.5, 2, "p50_s")},
        {_quantile(0.95, 2, "p95_s")}, round(max(latency_seconds), 2) AS max_s FROM det
        WHERE processed_at >= (SELECT max(batch_time) FROM cnt) - INTERVAL 15 MINUTE
        GROUP BY date_trunc('minute', processed_at)"""
    ),
    "throughput": _counts_query(
        f"""SELECT {_text("batch_time")} AS batch_time, {_n("sum(record_count)", "records")} FROM cnt
        WHERE NOT starts_with(label, '__')
          AND batch_time >= (SELECT max(batch_time) FROM cnt) - INTERVAL 15 MINUTE
        GROUP BY batch_time"""
    ),
    "event_time_format": f"""WITH {_REC} SELECT event_id, {_text(f"{_SECOND} + {_ZONE}", "%Y-%m-%d %H:%M")} AS minute_text,
      {_text(f"{_SECOND} + {_ZONE}")} AS second_text, {_text(f"{_SECOND} + {_ZONE}", "%H:%M:%S")} AS clock_text FROM rec""",
    "malformed_by_kind": _counts_query(
        f"""SELECT CASE label WHEN '{UNPARSEABLE}' THEN 'Unparseable (transmission)'
        WHEN '{INCOMPLETE}' THEN 'Incomplete (generation/schema)' ELSE label END AS failure_kind,
        {_n("sum(record_count)", "records")} FROM cnt WHERE starts_with(label, '__') GROUP BY label"""
    ),
    "batch_health": f"""WITH {_CNT}, {_health()} SELECT *,
      round(100 * ((unparseable + incomplete) / messages::DOUBLE), 6) AS malformed_pct FROM health""",
    "malformed_running": f"""WITH {_CNT}, {_health()} SELECT batch_id, unparseable, incomplete,
      {_n("sum(unparseable) OVER (ORDER BY batch_id)", "unparseable_so_far")},
      {_n("sum(incomplete) OVER (ORDER BY batch_id)", "incomplete_so_far")} FROM health""",
    "idle_streaks": f"""WITH {_EV},
      spine AS (SELECT unnest(range((SELECT min(batch_id) FROM ev), (SELECT max(batch_id) FROM ev) + 1)) AS batch_id),
      idle AS (SELECT s.batch_id, row_number() OVER (ORDER BY s.batch_id) AS rn
               FROM spine s WHERE s.batch_id NOT IN (SELECT batch_id FROM ev)),
      placed AS (SELECT batch_id, batch_id - rn AS streak,
                        row_number() OVER (PARTITION BY batch_id - rn ORDER BY batch_id) AS place FROM idle)
      SELECT min(batch_id) AS first_idle, max(batch_id) AS last_idle, count(*) AS idle_batches,
             count(*) FILTER (WHERE place = 1 OR place % 30 = 0) AS notices
      FROM placed GROUP BY streak""",
    "batch_cost_fit": f"""WITH {_EV} SELECT count(*) AS batches, round(regr_slope(ms, n), 4) AS ms_per_record,
      round(regr_intercept(ms, n), 4) AS fixed_ms FROM (
      SELECT count(*) AS n, (max(epoch_us(processed_at)) - min(epoch_us(ts))) / 1e3 AS ms FROM ev GROUP BY batch_id)""",
    "sink_roundtrip": _ROUND_TRIP,
    "stream_detect": _ROUND_TRIP,
    "reset_tables": f"""WITH {_DET} SELECT 'before reset' AS moment, 'detections' AS table_name, count(*) AS row_count FROM det
      UNION ALL SELECT 'before reset', 'traffic_counts', count(DISTINCT label) FROM cnt
      UNION ALL SELECT 'after reset', t, CAST(0 AS BIGINT) FROM (VALUES ('detections'), ('traffic_counts')) v(t)""",
    "delete_batch": _counts_query(
        f"""SELECT CAST(0 AS BIGINT) AS batch_id, label, {_n("sum(record_count)", "record_count")}
        FROM cnt WHERE minute(batch_time) < 30 GROUP BY label"""
    ),
    "delete_compacted": _det_query(
        f"""SELECT CAST(1 AS BIGINT) AS batch_id, c.label, {_n("sum(record_count)", "record_count")},
        {_n("coalesce(any_value(s.stored), 0)", "stored")}
        FROM cnt c LEFT JOIN (SELECT label, count(*) AS stored FROM det WHERE minute(processed_at) >= 30 GROUP BY label) s
          ON c.label = s.label
        WHERE minute(batch_time) >= 30 GROUP BY c.label"""
    ),
    "alerts_rollup": _det_query("SELECT * FROM alerts", _RUN_DET, _ALERTS.replace("FROM det ", "FROM run_det ")),
    "latency_rollup": _det_query(
        f"""SELECT {_text("processed_at")} AS "minute", round(max(latency_seconds), 2) AS max_s,
        true AS p50_near, true AS p95_near FROM run_det GROUP BY processed_at""",
        _RUN_DET,
    ),
    "drilldown_stored": _det_query(
        """SELECT * EXCLUDE (latency_s) FROM raw WHERE window_start IN
        (SELECT window_start FROM alerts WHERE verdict = 'FALSE POSITIVE')""",
        _ALERTS, _RAW,
    ),
    "report_export": _det_query(
        "SELECT * FROM ("
        + " UNION ALL ".join([
            _cells("window", "(SELECT count(DISTINCT batch_id) AS batches FROM cnt)", "batches"),
            _cells(
                "overall",
                f"(SELECT *, {_F1} FROM (SELECT tp, fn, fp, normal_total - fp AS tn, normal_total, "
                f"total_records - normal_total AS attack_total, total_records, {_RATES} FROM m))",
                "tp fn fp tn normal_total attack_total total_records precision recall false_positive_rate accuracy f1",
            ),
            _cells(
                "by_label", f"(SELECT *, {_F1} FROM lab)",
                "support stored caught predicted correct missed recall precision f1", "label",
            ),
            _cells(
                "latency",
                f"""(SELECT *, under_target / nullif(n, 0)::DOUBLE AS under_target_pct FROM (
                SELECT count(*) AS n, avg(latency_seconds) AS mean, {_quantile(0.5, 9, "p50")},
                {_quantile(0.95, 9, "p95")}, {_quantile(0.99, 9, "p99")}, max(latency_seconds) AS "max",
                min(latency_seconds) AS "min",
                {_n("count(*) FILTER (WHERE latency_seconds < 2)", "under_target")} FROM det))""",
                "n mean p50 p95 p99 max min under_target under_target_pct",
            ),
            _cells("malformed", f"(SELECT label, sum(record_count) AS total FROM cnt WHERE NOT ({_REAL}) GROUP BY label)", "total", "label"),
            _cells(
                "malformed_rate",
                f"""(SELECT *, malformed_total / nullif(messages, 0)::DOUBLE AS malformed_rate FROM (
                SELECT coalesce(sum(record_count) FILTER (WHERE NOT ({_REAL})), 0) AS malformed_total,
                sum(record_count) AS messages FROM cnt))""",
                "malformed_total messages malformed_rate",
            ),
            _cells("integrity", "checks", "passed expected actual", "concat_ws('/', check_name, label)"),
        ])
        + ") WHERE value IS NOT NULL",
        _CLAIMS, _confusion(), _label_rows(), f"checks AS ({_CHECKS})",
    ),
    "stream_progress": """SELECT 1 AS run, count(*) AS records, CAST(0 AS BIGINT) AS over_ceiling,
      false AS caught_up FROM events UNION ALL SELECT 2, CAST(0 AS BIGINT), CAST(0 AS BIGINT), true""",
    "stream_ingest": _counts_query(
        f"SELECT label, {_n('sum(record_count)', 'record_count')} FROM cnt GROUP BY label"
    ),
    "stream_resume": _counts_query(
        f"SELECT label, CAST(1 AS BIGINT) AS runs, {_n('sum(record_count)', 'record_count')} FROM cnt GROUP BY label"
    ),
}
