"""Rule sets over the given tables; rules bind to any schema."""

from __future__ import annotations

from wardline.operators.rules import Rule, parse_rules
from wardline.sources.adapters import (
    DOCUMENT_SCHEMA,
    EVENT_FORBIDDEN,
    EVENT_SCHEMA,
    LINE_SCHEMA,
)


def _rule(rule_id: str, attack_type: str, severity: str, *conditions: tuple) -> dict:
    return {
        "rule_id": rule_id, "attack_type": attack_type, "severity": severity,
        "conditions": [{"field": f, "op": op, "value": v} for f, op, v in conditions],
    }


def event_rules() -> list[Rule]:
    """Three rules on events; the first and last claim the same class."""
    users = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89]
    return parse_rules(
        [
            _rule("large_and_late", "error", "critical", ("value", ">=", 80), ("k", ">=", 30)),
            _rule("small_watched", "purchase", "medium", ("value", "<=", 5), ("user_id", "in", users)),
            _rule("middling_late", "error", "high", ("k", ">=", 60), ("value", ">=", 40)),
        ],
        EVENT_SCHEMA,
        EVENT_FORBIDDEN,
    )


def number_operator_rules() -> list[Rule]:
    """One rule per operator on a number, on events."""
    return parse_rules(
        [
            _rule("gt", "order", "low", ("k", ">", 70)),
            _rule("ge", "order", "low", ("k", ">=", 70)),
            _rule("lt", "order", "low", ("value", "<", 12.5)),
            _rule("le", "order", "low", ("k", "<=", 20)),
            _rule("eq_number", "exact", "medium", ("k", "==", 42)),
            _rule("ne_number", "exact", "medium", ("k", "!=", 42)),
            _rule("in_number", "exact", "critical", ("hour", "in", [0, 12, 23])),
            _rule("not_in_number", "exact", "critical", ("hour", "not_in", [0, 12, 23])),
        ],
        EVENT_SCHEMA,
        EVENT_FORBIDDEN,
    )


def text_operator_rules() -> list[Rule]:
    """One rule per operator on text, on documents."""
    return parse_rules(
        [
            _rule("eq_text", "language", "high", ("lang", "==", "en")),
            _rule("ne_text", "language", "high", ("lang", "!=", "en")),
            _rule("in_text", "language", "high", ("lang", "in", ["de", "fr"])),
            _rule("not_in_text", "language", "high", ("lang", "not_in", ["de", "fr"])),
        ],
        DOCUMENT_SCHEMA,
    )


def null_rules() -> list[Rule]:
    """Negative operators on a field that is often null."""
    return parse_rules(
        [
            _rule("not_ten", "a", "low", ("k", "!=", 10)),
            _rule("not_listed", "b", "medium", ("k", "not_in", [1, 2, 3])),
            _rule("small", "c", "high", ("k", "<=", 50), ("value", ">=", 1)),
        ],
        EVENT_SCHEMA,
        EVENT_FORBIDDEN,
    )


def line_rules() -> list[Rule]:
    """Six rules, seventeen conditions on order lines, for measuring."""
    return parse_rules(
        [
            _rule("bulk_discount", "A", "critical",
                  ("l_quantity", ">=", 45), ("l_discount", ">=", 0.08), ("l_tax", "<=", 0.02)),
            _rule("cheap_few", "R", "medium",
                  ("l_quantity", "<=", 5), ("l_extendedprice", "<=", 5000), ("l_tax", ">=", 0.06)),
            _rule("open_late_line", "R", "high", ("l_linestatus", "==", "O"), ("l_linenumber", ">=", 6)),
            _rule("dear_untaxed", "A", "high",
                  ("l_extendedprice", ">=", 60000), ("l_tax", "<=", 0.01),
                  ("l_discount", "<=", 0.01), ("l_quantity", ">=", 30)),
            _rule("first_line_deal", "R", "critical",
                  ("l_linenumber", "==", 1), ("l_discount", ">=", 0.09), ("l_quantity", "<=", 10)),
            _rule("closed_full_price", "A", "low",
                  ("l_linestatus", "==", "F"), ("l_discount", "<=", 0)),
        ],
        LINE_SCHEMA,
    )


def document_rules() -> list[Rule]:
    return parse_rules(
        [
            _rule("short", "toxic", "medium", ("n_chars", "<", 400)),
            _rule("long_foreign", "toxic", "low", ("n_chars", ">", 5000), ("lang", "not_in", ["en"])),
        ],
        DOCUMENT_SCHEMA,
    )
