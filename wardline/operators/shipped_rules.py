"""The default rule set for connection records."""

from __future__ import annotations

from wardline.operators.rules import Rule, parse_rules

# --- fixed values: six rules, seventeen conditions --------------------------
SHIPPED_RULES = [
    {
        "rule_id": "ddos_flood", "attack_type": "ddos", "severity": "critical",
        "conditions": [
            {"field": "count", "op": ">=", "value": 150},
            {"field": "serror_rate", "op": ">=", "value": 0.7},
            {"field": "dst_bytes", "op": "<=", "value": 20},
        ],
    },
    {
        "rule_id": "port_scan_sweep", "attack_type": "port_scan", "severity": "medium",
        "conditions": [
            {"field": "diff_srv_rate", "op": ">=", "value": 0.5},
            {"field": "same_srv_rate", "op": "<=", "value": 0.15},
            {"field": "rerror_rate", "op": ">=", "value": 0.4},
        ],
    },
    {
        "rule_id": "brute_force_login", "attack_type": "brute_force", "severity": "high",
        "conditions": [
            {"field": "num_failed_logins", "op": ">=", "value": 2},
            {"field": "count", "op": ">=", "value": 15},
        ],
    },
    {
        "rule_id": "malware_c2_beacon", "attack_type": "malware_c2", "severity": "high",
        "conditions": [
            {"field": "count", "op": "<=", "value": 8},
            {"field": "dst_host_count", "op": "<=", "value": 15},
            {"field": "dst_host_srv_count", "op": "<=", "value": 15},
            {"field": "same_srv_rate", "op": ">=", "value": 0.85},
        ],
    },
    {
        "rule_id": "data_exfiltration_outbound", "attack_type": "data_exfiltration",
        "severity": "critical",
        "conditions": [
            {"field": "src_bytes", "op": ">=", "value": 50000},
            {"field": "dst_bytes", "op": "<=", "value": 1000},
            {"field": "logged_in", "op": "==", "value": 1},
        ],
    },
    {
        "rule_id": "malicious_download_inbound", "attack_type": "malicious_download",
        "severity": "high",
        "conditions": [
            {"field": "dst_bytes", "op": ">=", "value": 65000},
            {"field": "src_bytes", "op": "<=", "value": 500},
        ],
    },
]
# --- end of fixed values ----------------------------------------------------


def shipped_rules() -> list[Rule]:
    return parse_rules(SHIPPED_RULES)
