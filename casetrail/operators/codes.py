"""Process codes of a rule, worked out once on the driver and carried as literals."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import display_name
from .rules import Rule, literal_is_nullish

# The code of a rule nobody classified, and the spellings of the status fields.
UNKNOWN_CODE = "UNKNOWN"
STATUS_BLOCK_NAMES = ("status", "STATUS", "Status")
STATUS_FIELDS = {
    "status": ("STATUS", "Status", "status"),
    "status_code": ("status_code", "Status_code", "STATUS_CODE"),
    "status_description": ("status_description", "Status_description", "STATUS_DESCRIPTION"),
}


def _codes(value: Any, split_paths: bool) -> list[str]:
    """Codes out of a path, a list or an object; parts that are empty are left out."""
    if isinstance(value, Mapping):
        parts = list(value.values())
    elif isinstance(value, list):
        parts = value
    else:
        parts = str(value).split("/") if split_paths else [value]
    return [str(p).strip() for p in parts if p] or [UNKNOWN_CODE]


def resolve_codes(rule: Rule, lifecycle: Mapping[str, Any]) -> tuple[list[str], Mapping[str, Any]]:
    """Code set and status block: the rule's own codes win and carry no status, then the
    lifecycle map decides."""
    if rule.code_set is not None:
        return _codes(rule.code_set, split_paths=True), {}
    entry = lifecycle.get(rule.key)
    if isinstance(entry, Mapping):
        status = next((entry[n] for n in STATUS_BLOCK_NAMES if entry.get(n)), {})
        codes = entry.get("code_set") or entry.get("class_path")
        return (
            _codes(codes, split_paths=False) if codes else [UNKNOWN_CODE],
            status if isinstance(status, Mapping) else {},
        )
    if isinstance(entry, list) or (isinstance(entry, str) and entry.strip()):
        return _codes(entry, split_paths=False), {}
    return [UNKNOWN_CODE], {}


def _quoted(text: str | None) -> str:
    """SQL literal of a text."""
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _block(code: str, display: str, code_set: list[str], code_system: str, extra: Mapping[str, str | None]) -> Column:
    """Literal struct, as one SQL expression: rule sets run to hundreds of rules, and a call per
    literal would make building the plan slow."""
    fields = {
        "code": _quoted(code),
        "code_display": _quoted(display),
        "code_set": f"array({', '.join(_quoted(c) for c in code_set)})",
        "code_system": _quoted(code_system),
        **{name: _quoted(value) for name, value in extra.items()},
    }
    return F.expr(f"named_struct({', '.join(f'{_quoted(name)}, {value}' for name, value in fields.items())})")


def process_block(rule: Rule, lifecycle: Mapping[str, Any], code_system: str) -> Column:
    """Literal struct that names the process step."""
    codes, status = resolve_codes(rule, lifecycle)
    extra = {}
    for target, spellings in STATUS_FIELDS.items():
        value = next((status[s] for s in spellings if status.get(s)), None)
        extra[target] = None if literal_is_nullish(value) else str(value)
    return _block(codes[-1], display_name(codes[-1]), codes, code_system, extra)


def coding_block(rule: Rule, code_map: Mapping[str, Any], code_system: str) -> Column:
    """Literal struct that names the reason of a hold."""
    info = code_map.get(rule.code)
    display = info.get("code_display") if isinstance(info, Mapping) else None
    if not display or literal_is_nullish(display):
        display = display_name(rule.code)
    return _block(rule.code, str(display), [rule.code], code_system, {})
