"""Rule sets: JSON logic trees turned into boolean Columns before any job starts."""

from __future__ import annotations

import json
import operator
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NULL_WORDS
from .facets import Attribute, Facets
from .patterns import PatternError, rewritten

# The operators of the rule grammar.
EMPTINESS = ("null", "not_null")
ORDERING: Mapping[str, Callable[[Any, Any], Column]] = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
}
OPERATORS = (*EMPTINESS, "=", "!=", *ORDERING, "in", "regex")


class RuleError(ValueError):
    """A rule set that cannot be compiled."""


@dataclass(frozen=True)
class Rule:
    """One entry of a rule set."""

    key: str
    logic: Mapping[str, Any]
    start: str | None = None
    end: str | None = None
    code_set: Any = None
    code: str | None = None

    def attributes(self) -> Iterator[str]:
        """Columns the rule reads."""
        yield from (a for a in (self.start, self.end) if a)
        yield from _attributes(self.logic)


@dataclass(frozen=True)
class Check:
    """A compiled test; ``may_fail`` marks one that voids its whole rule where it is NULL."""

    holds: Column
    may_fail: bool = False


def literal_is_nullish(value: Any) -> bool:
    return value is None or str(value).strip().lower() in ("", *NULL_WORDS)


def parse_rules(raw: Mapping[str, Any], source: str | None = None) -> list[Rule]:
    """Rules of a JSON object. With ``source``, rules of another source are left out;
    rules that name none always count."""
    rules = []
    if not isinstance(raw, Mapping):
        raise RuleError("rules must be a JSON object")
    for key, body in raw.items():
        if not isinstance(body, Mapping):
            raise RuleError(f"rule '{key}' must be a JSON object")
        named = body.get("source")
        if source and named and str(named).lower() != source.lower():
            continue
        rules.append(
            Rule(key, _logic_of(key, body), *_time_attributes(body),
                 code_set=body.get("code_set") or body.get("class_path"))
        )
    return rules


def parse_hold_rules(raw: Mapping[str, Any]) -> list[Rule]:
    """On-hold rules: the same grammar, each with a code of its own."""
    if not isinstance(raw, Mapping):
        raise RuleError("on-hold rules must be a JSON object")
    rules = []
    for key, body in raw.items():
        if not isinstance(body, Mapping):
            raise RuleError(f"on-hold rule '{key}' must be a JSON object")
        if literal_is_nullish(body.get("code")):
            raise RuleError(f"on-hold rule '{key}' has no code")
        rules.append(Rule(key, _logic_of(key, body), *_time_attributes(body), code=str(body["code"])))
    return rules


def required_columns(rules: Iterable[Rule], always: Iterable[str] = ()) -> list[str]:
    """Columns the rules read, first use first."""
    wanted: dict[str, str] = {}
    for name in (*always, *(a for rule in rules for a in rule.attributes())):
        wanted.setdefault(name.lower(), name)
    return list(wanted.values())


def missing_columns(df: DataFrame, rules: Iterable[Rule], always: Iterable[str] = ()) -> list[str]:
    """Preflight: columns the rules read that the table lacks. They read as NULL."""
    present = {name.lower() for name in df.columns}
    return sorted(c for c in required_columns(rules, always) if c.lower() not in present)


def match_column(rule: Rule, facets: Facets) -> Column:
    """Where the rule applies. Never NULL: a test that fails counts as no match."""
    try:
        compiled = compile_node(rule.logic, facets)
    except RuleError as problem:
        raise RuleError(f"rule '{rule.key}': {problem}") from problem
    return F.coalesce(compiled.holds, F.lit(False)) if compiled.may_fail else compiled.holds


def compile_node(node: Mapping[str, Any], facets: Facets) -> Check:
    """A logic tree: ``and`` before ``or``, empty ``and`` true, empty ``or`` false."""
    if not isinstance(node, Mapping):
        raise RuleError(f"expected an object with 'and' or 'or', not {node!r}")
    for word, stop_at in (("and", False), ("or", True)):
        if word in node:
            if not isinstance(node[word], list) or not all(isinstance(child, Mapping) for child in node[word]):
                raise RuleError(f"'{word}' must list objects")
            parts = [
                compile_node(child, facets) if {"and", "or"} & child.keys() else compile_test(child, facets)
                for child in node[word]
            ]
            return _combine(parts, stop_at)
    raise RuleError(f"expected 'and' or 'or' in {dict(node)!r}")


def _combine(parts: list[Check], stop_at: bool) -> Check:
    """Left to right, ending at the first part equal to ``stop_at`` or at one that fails."""
    holds = F.lit(not stop_at)
    may_fail = any(part.may_fail for part in parts)
    for part in parts:
        if may_fail:
            holds = F.when(holds.isNull() | (holds == F.lit(stop_at)), holds).otherwise(part.holds)
        else:
            holds = (holds | part.holds) if stop_at else (holds & part.holds)
    return Check(holds, may_fail)


def compile_test(node: Mapping[str, Any], facets: Facets) -> Check:
    """One test; equal tests of different rules share their column."""
    return facets.once(json.dumps(node, sort_keys=True, default=str), lambda: _compile_test(node, facets))


def _compile_test(node: Mapping[str, Any], facets: Facets) -> Check:
    op, name = node.get("op"), node.get("attr")
    if not op or not name:
        raise RuleError(f"a test needs 'op' and 'attr': {dict(node)!r}")
    if op not in OPERATORS:
        raise RuleError(f"unknown operator {op!r} in {dict(node)!r}")
    value, other = node.get("value"), node.get("other_attr")
    if op == "regex" and isinstance(value, str):
        try:
            pattern = rewritten(value)
        except PatternError as problem:
            raise RuleError(f"bad pattern {value!r}: {problem}") from problem

    left = facets.attribute(name)
    if op in EMPTINESS:
        return Check(left.nullish if op == "null" else ~left.nullish)
    if other:
        right = facets.attribute(other)
        usable = ~left.nullish & ~right.nullish
        if op == "regex":
            return Check(F.when(~usable, F.lit(False)), may_fail=True)
        return Check(_guarded(usable, _with_attribute(op, left, right)))
    if literal_is_nullish(value):
        return Check(F.lit(False))
    if op == "regex":
        if not isinstance(value, str):
            return Check(F.when(left.nullish, F.lit(False)), may_fail=True)
        return Check(_guarded(~left.nullish, left.printed.rlike(pattern)))
    return Check(_guarded(~left.nullish, _with_literal(op, left, value)))


def _guarded(usable: Column, outcome: Column | None) -> Column:
    """False where an operand is missing or the two kinds do not compare."""
    if outcome is None:
        return F.lit(False)
    return F.coalesce(F.when(usable, outcome), F.lit(False))


def _with_literal(op: str, left: Attribute, value: Any) -> Column | None:
    if op == "in":
        return _within_literal(left, value)
    if op == "=":
        return _equals_literal(left, value)
    if op == "!=":
        return ~F.coalesce(_equals_literal(left, value), F.lit(False))
    if left.kind == "text" and isinstance(value, str):
        return left.instant.isNull() & ORDERING[op](left.value, F.lit(value))
    if left.kind == "number" and isinstance(value, (bool, int, float)):
        return ~left.unordered & ORDERING[op](left.numeric, _number(value))
    return None


def _equals_literal(left: Attribute, value: Any) -> Column:
    """Typed equality: date-like text is a date, so it equals no text."""
    if left.kind == "text" and isinstance(value, str):
        return left.instant.isNull() & (left.value == F.lit(value))
    if left.kind == "number" and isinstance(value, (bool, int, float)):
        return ~left.unordered & (left.numeric == _number(value))
    return F.lit(False)


def _within_literal(left: Attribute, value: Any) -> Column | None:
    if isinstance(value, str):
        if left.kind != "text":
            return None
        return left.instant.isNull() & F.contains(F.lit(value), left.value)
    if not isinstance(value, (list, Mapping)):
        return None
    texts = [v for v in value if isinstance(v, str)]
    numbers = [v for v in value if isinstance(v, (bool, int, float))]
    if left.kind == "text" and texts:
        return left.instant.isNull() & left.value.isin(texts)
    if left.kind == "number" and numbers:
        return ~left.unordered & left.numeric.isin([_number(v) for v in numbers])
    return None


def _number(value: bool | int | float) -> Column:
    return F.lit(int(value)) if isinstance(value, bool) else F.lit(value)


def _with_attribute(op: str, left: Attribute, right: Attribute) -> Column | None:
    if op == "in":
        if left.kind == right.kind == "text":
            return left.instant.isNull() & right.instant.isNull() & F.contains(right.value, left.value)
        return None
    compare = ORDERING.get(op, operator.eq)
    outcome = _same_kind(compare, left, right)
    if op == "!=":
        return ~F.coalesce(outcome, F.lit(False)) if outcome is not None else F.lit(True)
    return outcome


def _same_kind(compare: Callable[[Any, Any], Column], left: Attribute, right: Attribute) -> Column | None:
    kinds = {left.kind, right.kind}
    if kinds == {"number"}:
        return ~left.unordered & ~right.unordered & compare(left.numeric, right.numeric)
    if kinds == {"day"}:
        return compare(left.value, right.value)
    if not kinds <= {"text", "instant"}:
        return None
    as_instants = (left.zoned == right.zoned) & compare(left.instant, right.instant)
    if kinds == {"text"}:
        plain = left.instant.isNull() & right.instant.isNull()
        return F.when(plain, compare(left.value, right.value)).otherwise(as_instants)
    return as_instants


def _logic_of(key: str, body: Mapping[str, Any]) -> Mapping[str, Any]:
    logic = body.get("logic")
    if not isinstance(logic, Mapping):
        raise RuleError(f"rule '{key}' has no logic")
    return logic


def _time_attributes(body: Mapping[str, Any]) -> tuple[str | None, str | None]:
    return tuple(
        (body.get(f"{side}_date") or {}).get("attr") or body.get(f"{side}_attr") for side in ("start", "end")
    )


def _attributes(node: Mapping[str, Any]) -> Iterator[str]:
    yield from (str(node[word]) for word in ("attr", "other_attr") if node.get(word))
    for word in ("and", "or"):
        for child in node.get(word) or ():
            yield from _attributes(child)
