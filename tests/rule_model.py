"""Row-at-a-time model of the rule semantics, kept apart from the library.

Values are sorted into kinds first; what two kinds do to each other is then a table look-up.
"""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

FAILS = "fails"
SHAPE = re.compile(r"\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?([+-]\d{2}(:?\d{2})?)?)?")
COMPARE = {
    "=": lambda a, b: a == b, "!=": lambda a, b: a != b, ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
}


def kind_of(value):
    """(kind, comparable value) of a cell."""
    if value is None or (isinstance(value, str) and value.strip().lower() in ("", "null", "nat")):
        return "none", None
    if isinstance(value, str):
        cut = value.replace("Z", "")
        if SHAPE.fullmatch(cut):
            try:
                stamp = dt.datetime.fromisoformat(cut)
            except ValueError:
                return "text", value
            return ("zoned" if stamp.tzinfo else "instant"), stamp
        return "text", value
    if isinstance(value, dt.datetime):
        return "instant", value
    if isinstance(value, dt.date):
        return "day", value
    return "number", value


def literal_kind(value):
    if isinstance(value, str):
        return ("none", None) if value.strip().lower() in ("", "null", "nat") else ("text", value)
    if value is None:
        return "none", None
    return ("list", value) if isinstance(value, list) else ("number", value)


def test_holds(test, row):
    op = test["op"]
    kind, left = kind_of(row.get(test["attr"]))
    if op in ("null", "not_null"):
        return (kind == "none") == (op == "null")
    by_column = "other_attr" in test
    other, right = kind_of(row.get(test["other_attr"])) if by_column else literal_kind(test.get("value"))
    if "none" in (kind, other):
        return False
    if op == "regex":
        if by_column or other != "text":
            return FAILS
        return re.search(right, printed(kind, left)) is not None
    if op == "in":
        if other == "list":
            return any(kind == literal_kind(v)[0] and left == v for v in right)
        return kind == other == "text" and left in right
    same = kind == other
    if op == "=":
        return same and left == right
    if op == "!=":
        return not (same and left == right)
    if any(v != v for v in (left, right)):
        return False  # NaN has no order
    return same and COMPARE[op](left, right)


def printed(kind, value):
    if isinstance(value, bool):
        return str(value)
    if kind == "number" and isinstance(value, Decimal):
        return f"{value:f}"
    return str(value)


def tree_holds(node, row):
    """A part that fails voids the whole tree unless the answer is known before it."""
    word = "and" if "and" in node else "or"
    decisive = word == "or"
    for part in node[word]:
        answer = tree_holds(part, row) if {"and", "or"} & part.keys() else test_holds(part, row)
        if answer is FAILS or answer is decisive:
            return answer
    return not decisive


def rule_holds(tree, row):
    return tree_holds(tree, row) is True
