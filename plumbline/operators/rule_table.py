"""Rules switched, tightened and added by the rows of the rule catalogue.

A catalogue row says what must hold. Its type decides which forms of a condition are
understood; what is not understood keeps the built-in predicate of that rule id:

* ``not_null``: none of the named fields is NULL.
* ``range``, ``threshold``, ``date_window``, ``timeliness``: ``field >= 10``,
  ``day <= current_date`` (the run's date), ``day < 2024-06-01`` or
  ``field <= other_field + 24 hours``. NULL never fails.
* ``accepted_values``, ``status``: ``field in A, B, C``. NULL fails.
* ``unique_grain``: ``COUNT(*) by a + b <= 1`` on the grain that is counted.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import is_true
from plumbline.operators.rules import PRIMARY_TYPE_ORDER, READING_RULES, Rule, RuleContext

# A catalogue is read on the driver, as it becomes part of the plan.
MOST_RULES = 1000

# The opposite of a comparison that must hold.
FAILING = {
    ">=": lambda a, b: a < b, "<=": lambda a, b: a > b, ">": lambda a, b: a <= b,
    "<": lambda a, b: a >= b, "=": lambda a, b: a != b, "!=": lambda a, b: a == b,
}
NUMBER = r"[-+]?\d+(?:\.\d+)?"
COMPARISON = re.compile(rf"(\w+) (>=|<=|!=|>|<|=) (?:({NUMBER})|(current_date)|(\d{{4}}-\d\d-\d\d)|(\w+) \+ (\d+) hours?)")
MEMBERSHIP = re.compile(r"(\w+) in ([\w-]+(?:, *[\w-]+)*)", re.IGNORECASE)
GRAIN = re.compile(r"COUNT\(\*\) by ([\w +]+?) <= (\d+)", re.IGNORECASE)

# Catalogue names of columns that have another name in the checked table (fixed values).
FIELD_NAMES = {"facility_id": "source_facility_id"}
GRAIN_COUNT = {("meter_id", "reading_timestamp"): "duplicate_meter_timestamp_count"}

Predicate = Callable[[RuleContext], Column]


def _field(name: str) -> str:
    return FIELD_NAMES.get(name, name)


def _comparison(text: str) -> Predicate | None:
    found = COMPARISON.fullmatch(text)
    if not found:
        return None
    field, sign, number, today, day, other, hours = found.groups()

    def fails(c: RuleContext) -> Column:
        if number is not None:
            limit = F.lit(float(number))
        elif other is not None:
            limit = c.col(_field(other)) + F.make_dt_interval(hours=F.lit(int(hours)))
        else:
            limit = F.lit(c.as_of if today else day).cast("date")
        return FAILING[sign](c.col(_field(field)), limit)

    return fails


def _membership(text: str) -> Predicate | None:
    found = MEMBERSHIP.fullmatch(text)
    if not found:
        return None
    field, values = found.group(1), [v.strip() for v in found.group(2).split(",")]
    return lambda c: ~is_true(c.col(_field(field)).isin(*values))


def _grain(text: str) -> Predicate | None:
    found = GRAIN.fullmatch(text)
    counted = found and GRAIN_COUNT.get(tuple(x.strip() for x in found.group(1).split("+")))
    if not counted:
        return None
    most = int(found.group(2))
    return lambda c: c.col(counted) > most


def _not_null(fields: str) -> Predicate | None:
    names = [_field(x.strip()) for x in fields.split(",") if x.strip()]
    if not names:
        return None

    def fails(c: RuleContext) -> Column:
        missing = c.col(names[0]).isNull()
        for name in names[1:]:
            missing = missing | c.col(name).isNull()
        return missing

    return fails


def predicate(rule_type: str, field_name: str, condition: str) -> Predicate | None:
    """What makes a row fail a catalogue rule; None if its condition is not understood."""
    if rule_type == "not_null":
        return _not_null(field_name)
    if rule_type == "unique_grain":
        return _grain(condition)
    if rule_type in ("accepted_values", "status"):
        return _membership(condition)
    if rule_type in ("range", "threshold", "date_window", "timeliness"):
        return _comparison(condition)
    return None


@dataclass(frozen=True)
class RuleSet:
    """The rules in force, and what became of each catalogue row: BUILT_IN (the built-in
    predicate), COMPILED (from the row), OFF, or UNREAD (unknown id whose condition is not
    understood: it checks nothing)."""

    rules: tuple[Rule, ...]
    outcome: Mapping[str, str]

    @property
    def order(self) -> tuple[str, ...]:
        """Which failed rule names the row: the fixed order, then added rules as listed."""
        return (*PRIMARY_TYPE_ORDER, *[r.exception_type for r in self.rules if r.exception_type not in PRIMARY_TYPE_ORDER])


def _row_text(row: Mapping, name: str) -> str:
    return " ".join((row[name] or "").split())


def compile_rules(catalogue: DataFrame, layer: str = "Silver", base: Sequence[Rule] = READING_RULES) -> RuleSet:
    """The rules in force by a standardized catalogue.

    A built-in rule that the catalogue does not list stays as it is; one that it lists is
    off unless active, takes its severity from the row, and its predicate if the condition
    is understood. Other active rows of ``layer`` become rules of their own. A rule that is
    off keeps its flag, which is false. Of a repeated id the last row by name counts.
    """
    columns = ("rule_id", "rule_name", "layer", "field_name", "rule_type", "condition_description", "severity", "business_reason", "is_active")
    rows = catalogue.where("rule_id IS NOT NULL").select(*columns).limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"The rule catalogue has more than {MOST_RULES} rows")
    listed = {r.rule_id: r.asDict() for r in sorted(rows, key=lambda r: (r.rule_id, r.rule_name or ""))}
    rules, outcome = [], {}
    for rule in base:
        row = listed.get(rule.rule_id)
        if row is None:
            rules.append(rule)
        elif not row["is_active"]:
            rules.append(replace(rule, fails=lambda c: F.lit(False)))
            outcome[rule.rule_id] = "OFF"
        else:
            fails = predicate(_row_text(row, "rule_type").lower(), _row_text(row, "field_name"), _row_text(row, "condition_description"))
            rules.append(replace(rule, severity=row["severity"] or rule.severity, fails=fails or rule.fails))
            outcome[rule.rule_id] = "COMPILED" if fails else "BUILT_IN"
    own = {r.rule_id for r in base}
    for rule_id, row in listed.items():
        if rule_id in own or (row["layer"] or "").lower() != layer.lower():
            continue
        fails = predicate(_row_text(row, "rule_type").lower(), _row_text(row, "field_name"), _row_text(row, "condition_description"))
        if not row["is_active"] or fails is None:
            outcome[rule_id] = "UNREAD" if row["is_active"] else "OFF"
            continue
        kind = rule_id.upper().removeprefix("DQ_")
        rules.append(Rule(rule_id, kind, row["severity"] or "Medium", f"dq_{kind.lower()}", row["business_reason"] or "", fails))
        outcome[rule_id] = "COMPILED"
    return RuleSet(tuple(rules), outcome)
