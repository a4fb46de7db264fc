"""Detection rules: validation, compilation to Column expressions, evaluation.

A rule is an AND of conditions, a rule set an OR of rules.  Evaluation runs in
two projections.  The first sets one bit per rule in a long "hit mask"; the
second reads the four verdict columns off that mask.  Every condition is thus
computed once per row, and the rows that hit nothing - nearly all of them -
never build an array.  Only built-in, code-generated expressions are used, so
batch and streaming plans stay inside whole-stage codegen.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType, StructType

from wardline.schema import FORBIDDEN_FIELDS, RECORD_SCHEMA, SEVERITIES, VERDICT_FIELDS
from wardline.sources import files

#: Bits used of each mask column; the sign bit stays clear.
MASK_BITS = 63

RULE_KEYS = {"rule_id", "attack_type", "severity", "conditions"}
OPTIONAL_RULE_KEYS = {"description"}
CONDITION_KEYS = {"field", "op", "value"}


class RuleLoadError(ValueError):
    """A rule set that is malformed, or that could never do what it says."""


@dataclass(frozen=True)
class Condition:
    field: str
    op: str
    value: Any


@dataclass(frozen=True)
class Rule:
    rule_id: str
    attack_type: str
    severity: str
    conditions: tuple[Condition, ...]
    description: str = ""


class Operator(NamedTuple):
    build: Callable[[Column, Any], Column]
    takes_list: bool = False
    numeric_only: bool = False


OPERATORS: dict[str, Operator] = {
    ">": Operator(lambda c, v: c > F.lit(v), numeric_only=True),
    ">=": Operator(lambda c, v: c >= F.lit(v), numeric_only=True),
    "<": Operator(lambda c, v: c < F.lit(v), numeric_only=True),
    "<=": Operator(lambda c, v: c <= F.lit(v), numeric_only=True),
    "==": Operator(lambda c, v: c == F.lit(v)),
    "!=": Operator(lambda c, v: c != F.lit(v)),
    "in": Operator(lambda c, v: c.isin(list(v)), takes_list=True),
    "not_in": Operator(lambda c, v: ~c.isin(list(v)), takes_list=True),
}


# --- validation -------------------------------------------------------------

def _mismatch(data_type: DataType, value: Any) -> str | None:
    """Why ``value`` cannot be compared with a field of ``data_type``."""
    is_number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if isinstance(data_type, NumericType):
        if not is_number:
            return "is not a number"
        if isinstance(value, float) and not math.isfinite(value):
            return "is not finite"
        if isinstance(value, int) and not -(2**63) <= value < 2**63:
            return "does not fit in 64 bits"
        return None
    if isinstance(data_type, StringType):
        return None if isinstance(value, str) else "is not a string"
    if isinstance(data_type, BooleanType):
        return None if isinstance(value, bool) else "is not a boolean"
    return f"cannot be compared with a {data_type.simpleString()} field"


def _condition_problems(raw: Any, types: dict[str, DataType], forbidden: frozenset) -> Iterator[str]:
    if not isinstance(raw, dict):
        yield "must be an object"
        return
    if raw.keys() != CONDITION_KEYS:
        yield f"needs exactly the keys {sorted(CONDITION_KEYS)}, has {sorted(map(str, raw))}"
        return

    field, op, value = raw["field"], raw["op"], raw["value"]
    if not isinstance(field, str):
        yield f"field {field!r} must be a string"
    elif field in forbidden:
        yield f"field '{field}' is ground truth and closed to rules"
    elif field not in types:
        yield f"field '{field}' is not in the record schema"
    if not isinstance(op, str) or op not in OPERATORS:
        yield f"operator {op!r} is not one of {list(OPERATORS)}"
        return
    if not isinstance(field, str) or field in forbidden or field not in types:
        return

    operator, data_type = OPERATORS[op], types[field]
    if operator.numeric_only and not isinstance(data_type, NumericType):
        yield f"operator '{op}' needs a numeric field, '{field}' is {data_type.simpleString()}"
        return
    if operator.takes_list:
        if not isinstance(value, (list, tuple)) or not value:
            yield f"operator '{op}' needs a non-empty list, got {value!r}"
            return
        candidates: Sequence[Any] = value
    else:
        candidates = [value]
    for candidate in candidates:
        reason = _mismatch(data_type, candidate)
        if reason:
            yield f"value {candidate!r} for '{field}' {reason}"


def _rule_problems(raw: Any, types: dict[str, DataType], forbidden: frozenset) -> Iterator[str]:
    if not isinstance(raw, dict):
        yield "must be an object"
        return
    missing = RULE_KEYS - raw.keys()
    if missing:
        yield f"lacks {sorted(missing)}"
        return
    unknown = raw.keys() - RULE_KEYS - OPTIONAL_RULE_KEYS
    if unknown:
        yield f"has unknown keys {sorted(map(str, unknown))}"
    for key in ("rule_id", "attack_type"):
        if not isinstance(raw[key], str) or not raw[key].strip():
            yield f"{key} must be a non-blank string"
    if not isinstance(raw["severity"], str) or raw["severity"] not in SEVERITIES:
        yield f"severity {raw['severity']!r} is not one of {list(SEVERITIES)}"
    if not isinstance(raw.get("description", ""), str):
        yield "description must be a string"
    conditions = raw["conditions"]
    if not isinstance(conditions, list) or not conditions:
        yield "conditions must be a non-empty list; a rule without any matches everything"
        return
    for i, condition in enumerate(conditions):
        for problem in _condition_problems(condition, types, forbidden):
            yield f"condition {i}: {problem}"


def parse_rules(
    raw: Any,
    schema: StructType = RECORD_SCHEMA,
    forbidden: frozenset | set = FORBIDDEN_FIELDS,
) -> list[Rule]:
    """Validate a deserialised rule list against a record schema.

    All problems are reported together in one ``RuleLoadError``.
    """
    if not isinstance(raw, list) or not raw:
        raise RuleLoadError("a rule set must be a non-empty JSON array")
    types = {field.name: field.dataType for field in schema.fields}

    problems: list[str] = []
    owner: dict[str, int] = {}
    for i, item in enumerate(raw):
        problems += [f"rule {i}: {p}" for p in _rule_problems(item, types, frozenset(forbidden))]
        rule_id = item.get("rule_id") if isinstance(item, dict) else None
        if isinstance(rule_id, str) and owner.setdefault(rule_id, i) != i:
            problems.append(f"rule {i}: rule_id '{rule_id}' is already used by rule {owner[rule_id]}")
    if problems:
        raise RuleLoadError("; ".join(problems))

    def freeze(value: Any) -> Any:
        return tuple(value) if isinstance(value, (list, tuple)) else value

    return [
        Rule(
            rule_id=item["rule_id"],
            attack_type=item["attack_type"],
            severity=item["severity"],
            conditions=tuple(
                Condition(c["field"], c["op"], freeze(c["value"])) for c in item["conditions"]
            ),
            description=item.get("description", ""),
        )
        for item in raw
    ]


def load_rules(
    path: str,
    schema: StructType = RECORD_SCHEMA,
    forbidden: frozenset | set = FORBIDDEN_FIELDS,
) -> list[Rule]:
    """Read and validate a JSON rule file on the driver (configuration, not data).

    A path with a scheme is read from that storage through the active session.
    """
    try:
        if "://" in path:
            text = files.read(SparkSession.getActiveSession(), path)
            if text is None:
                raise FileNotFoundError(path)
        else:
            with open(path, encoding="utf-8") as handle:
                text = handle.read()
        raw = json.loads(text)
    except OSError as error:
        raise RuleLoadError(f"cannot read rule file {path}: {error}") from error
    except ValueError as error:
        raise RuleLoadError(f"rule file {path} is not valid JSON: {error}") from error
    return parse_rules(raw, schema, forbidden)


# --- compilation ------------------------------------------------------------

def _all_conditions(rule: Rule) -> Column:
    """True where every condition holds; false or null elsewhere.

    A null feature makes its comparison null, never true, and an AND with a
    null in it is never true either.
    """
    return reduce(
        and_, [OPERATORS[c.op].build(F.col(f"`{c.field}`"), c.value) for c in rule.conditions]
    )


def rule_predicate(rule: Rule) -> Column:
    """One rule as a never-null boolean: a null feature does not match."""
    return F.coalesce(_all_conditions(rule), F.lit(False))


def _hit_masks(rules: Sequence[Rule]) -> list[Column]:
    masks = []
    for start in range(0, len(rules), MASK_BITS):
        bits = [
            # the ELSE branch also takes the null predicates of null features
            F.when(_all_conditions(rule), F.lit(1 << i).cast("bigint")).otherwise(
                F.lit(0).cast("bigint")
            )
            for i, rule in enumerate(rules[start : start + MASK_BITS])
        ]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), bits))
    return masks


def _read_masks(rules: Sequence[Rule], masks: Sequence[Column]) -> dict[str, Column]:
    """The verdict columns, given one mask column per ``MASK_BITS`` rules."""
    nothing = F.array().cast("array<string>")
    if not rules:
        return dict(
            zip(VERDICT_FIELDS, [nothing, nothing, F.lit(None).cast("string"), F.lit(False)])
        )

    def any_of(chosen: Sequence[int]) -> Column:
        words: dict[int, int] = {}
        for i in chosen:
            words[i // MASK_BITS] = words.get(i // MASK_BITS, 0) | 1 << i % MASK_BITS
        return reduce(
            or_,
            [masks[w].bitwiseAND(F.lit(bits).cast("bigint")) != 0 for w, bits in words.items()],
        )

    hit = reduce(or_, [mask != 0 for mask in masks])

    def named(names: Sequence[str]) -> Column:
        """Names of the matched rules in rule order, each name once.

        A rule adds its name unless an earlier match has already done so, so
        no pass over the finished array is needed to drop repeats.
        """
        parts, bearers = [], {}
        for i, name in enumerate(names):
            earlier = bearers.setdefault(name, [])
            adds = any_of([i]) & ~any_of(earlier) if earlier else any_of([i])
            parts.append(F.when(adds, F.array(F.lit(name))).otherwise(nothing))
            earlier.append(i)
        return F.when(hit, F.concat(*parts)).otherwise(nothing)

    severity = F.lit(None).cast("string")
    for level in SEVERITIES:
        of_level = [i for i, rule in enumerate(rules) if rule.severity == level]
        if of_level:
            severity = F.when(any_of(of_level), F.lit(level)).otherwise(severity)

    return dict(
        zip(
            VERDICT_FIELDS,
            [
                named([rule.rule_id for rule in rules]),
                named([rule.attack_type for rule in rules]),
                severity,
                hit,
            ],
        )
    )


def compile_rules(rules: Sequence[Rule]) -> dict[str, Column]:
    """The four verdict columns as expressions over the record fields."""
    return _read_masks(rules, _hit_masks(rules))


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Append the verdict columns to ``df``; batch and streaming alike."""
    present = set(df.columns)
    absent = {c.field for rule in rules for c in rule.conditions} - present
    if absent:
        raise RuleLoadError(f"the input lacks fields that rules read: {sorted(absent)}")
    clash = present & set(VERDICT_FIELDS)
    if clash:
        raise RuleLoadError(f"the input already has verdict columns: {sorted(clash)}")

    masks = _hit_masks(rules)
    names = [f"_hits{i}" for i in range(len(masks))]
    staged = df.withColumns(dict(zip(names, masks))) if masks else df
    verdicts = _read_masks(rules, [F.col(name) for name in names])
    return staged.withColumns(verdicts).drop(*names)
