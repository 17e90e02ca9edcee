"""Event records: one nested record per staged row, or one flat row per event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, ids, numbers, text
from ..schemas import column_of
from .codes import coding_block, process_block
from .facets import Attribute, Facets
from .rules import Rule, match_column

# Constants of an event record.
RECORD_VERSION = "0.1.0"
RECORD_KIND = "Permit"
ENTRY_KIND = "Record"
MISSING_RECORD_ID = "Error record_id"
DATETIME_MODE, DATE_MODE = "DATETIME", "DATE"

_EVENT = "struct<start_date:string,start_datetime:string,end_date:string,end_datetime:string>"
_CODED = "code:string,code_display:string,code_set:array<string>,code_system:string"
PROCESS_EVENTS = (
    f"array<struct<event:{_EVENT},process:struct<{_CODED},status:string,"
    "status_code:string,status_description:string>>>"
)
HOLD_EVENTS = f"array<struct<event:{_EVENT},coding:struct<{_CODED}>>>"


@dataclass(frozen=True)
class RecordSpec:
    """What a job's records carry besides their events."""

    id_column: str
    default_system_id: str
    process_code_system: str
    hold_code_system: str = ""
    system_column: str = "system_id"
    record_kind: str = RECORD_KIND
    version: str = RECORD_VERSION
    time_mode: str = DATETIME_MODE
    lifecycle: Mapping[str, Any] = field(default_factory=dict)
    hold_code_map: Mapping[str, Any] = field(default_factory=dict)


def time_block(start: Attribute | None, end: Attribute | None, mode: str = DATETIME_MODE) -> Column:
    """Start and end of an event as text.

    A side that yields no time falls back to its date; if the end lies before the start, both do.
    In date mode only the dates are kept.
    """
    nothing = F.lit(None).cast("string")
    start_day = start.event_date if start else nothing
    end_day = end.event_date if end else nothing
    if mode == DATE_MODE:
        return _times(start_day, nothing, end_day, nothing)
    start_time = start.event_datetime if start else nothing
    end_time = end.event_datetime if end else nothing
    if start and end:
        unsure = any(side.kind in ("text", "number", "other") for side in (start, end))
        backwards = dates.runs_backwards(start_time, end_time, may_be_invalid=unsure)
        start_time, end_time = F.when(~backwards, start_time), F.when(~backwards, end_time)
    return _times(
        F.when(start_time.isNull(), start_day), start_time,
        F.when(end_time.isNull(), end_day), end_time,
    )


def _times(start_date: Column, start_datetime: Column, end_date: Column, end_datetime: Column) -> Column:
    return F.struct(
        start_date.alias("start_date"), start_datetime.alias("start_datetime"),
        end_date.alias("end_date"), end_datetime.alias("end_datetime"),
    )


def _rule_times(rule: Rule, facets: Facets, mode: str) -> Column:
    """Time block of a rule; rules with the same start and end share it."""
    start = facets.attribute(rule.start) if rule.start else None
    end = facets.attribute(rule.end) if rule.end else None
    name = f"times:{mode}:{start.name if start else ''}:{end.name if end else ''}"
    return facets.share(name, lambda: time_block(start, end, mode))


def process_events(rules: Sequence[Rule], facets: Facets, spec: RecordSpec) -> list[Column]:
    """One struct per rule, NULL where the rule does not apply."""
    return [
        F.when(
            match_column(rule, facets),
            F.struct(
                _rule_times(rule, facets, spec.time_mode).alias("event"),
                process_block(rule, spec.lifecycle, spec.process_code_system).alias("process"),
            ),
        )
        for rule in rules
    ]


def hold_events(rules: Sequence[Rule], facets: Facets, spec: RecordSpec) -> list[Column]:
    """One struct per on-hold rule, NULL where it does not apply or gives no start."""
    events = []
    for rule in rules:
        times = _rule_times(rule, facets, spec.time_mode)
        started = times.getField("start_date").isNotNull() | times.getField("start_datetime").isNotNull()
        events.append(
            F.when(
                match_column(rule, facets) & started,
                F.struct(
                    times.alias("event"),
                    coding_block(rule, spec.hold_code_map, spec.hold_code_system).alias("coding"),
                ),
            )
        )
    return events


def event_array(events: Sequence[Column], kind: str) -> Column:
    """Events in rule order, those that do not apply left out."""
    return F.array_compact(F.array(*events)) if events else F.array().cast(kind)


def rows_with_events(rows: DataFrame, keep: Sequence[Column], events: Column, name: str) -> DataFrame:
    """Rows that have any event, with the array of them.

    A generator drops the rows without one. A filter on the array would be pushed below the
    projections that feed it, and every rule would be worked out twice, from scratch.
    """
    some = F.filter(F.array(F.struct(events.alias(name))), lambda row: F.size(row[name]) > 0)
    return rows.select(*keep, F.inline(some))


def record_id(df: DataFrame, spec: RecordSpec) -> tuple[Column, Column]:
    """Id text, and whether it is a whole number. Text that is no number stays as it is."""
    value, dtype = column_of(df, spec.id_column)
    whole = numbers.whole_number_text(value, dtype)
    return (
        F.coalesce(whole, text.attribute_text(value, dtype), F.lit(MISSING_RECORD_ID)),
        whole.isNotNull(),
    )


def system_id(df: DataFrame, spec: RecordSpec) -> Column:
    value, dtype = column_of(df, spec.system_column)
    return F.coalesce(text.text_or_null(value, dtype), F.lit(spec.default_system_id))


def build_records(rows: DataFrame, spec: RecordSpec) -> DataFrame:
    """Event-set records from rows that carry ``process_event_set`` and ``on_hold_event_set``.

    One record per row; rows with the same id stay apart.
    """
    id_text, id_is_number = record_id(rows, spec)
    return rows.select(
        F.lit(spec.version).alias("version"),
        F.lit(ENTRY_KIND).alias("kind"),
        system_id(rows, spec).alias("system_id"),
        id_text.alias("record_id"),
        id_is_number.alias("record_id_is_number"),
        F.lit(spec.record_kind).alias("record_kind"),
        "on_hold_event_set",
        "process_event_set",
    )


def record_json(records: DataFrame, transaction_id: Column | None = None) -> DataFrame:
    """One JSON text per record. Absent fields are left out, an empty array stays,
    a numeric id is written without quotes."""
    before = F.to_json(F.struct(
        (ids.time_ordered_uuid() if transaction_id is None else transaction_id).alias("transaction_id"),
        "version", "kind", "system_id",
    ))
    quoted_id = F.to_json(F.struct("record_id"))
    after = F.to_json(F.struct("record_kind", "on_hold_event_set", "process_event_set"))
    # The digits of a number go into the text as they are: no type holds ids of every length.
    own = F.when(F.col("record_id_is_number"), F.concat(F.lit('{"record_id":'), F.col("record_id"), F.lit("}"))).otherwise(quoted_id)
    line = F.concat(
        F.substring(before, 1, F.length(before) - 1), F.lit(","),
        F.substring(own, F.lit(2), F.length(own) - 2), F.lit(","), F.substring(after, F.lit(2), F.length(after)),
    )
    return records.select("record_id", line.alias("value"))


def flat_events(rows: DataFrame, facets: Facets, events: Sequence[Column], rules: Sequence[Rule],
                keep: Sequence[Column], block: str) -> DataFrame:
    """One row per event: no array per record is ever built, so a record may have any number.

    ``block`` names the struct that holds the code (``process`` or ``coding``).
    """
    if not rules:
        raise ValueError("flat events need at least one rule")
    tagged = F.array_compact(
        F.array(*[
            F.when(event.isNotNull(), F.struct(F.lit(i).alias("rule_no"), F.lit(rule.key).alias("rule"),
                                               event.alias("e")))
            for i, (rule, event) in enumerate(zip(rules, events, strict=True))
        ])
    )
    return (
        facets.project(rows)
        .select(*keep, F.inline(tagged))
        .select(
            *[F.col(name) for name in _names(rows, keep)],
            "rule_no", "rule",
            F.col(f"e.{block}.code").alias("code"),
            F.col("e.event.start_date"), F.col("e.event.start_datetime"),
            F.col("e.event.end_date"), F.col("e.event.end_datetime"),
        )
    )


def _names(rows: DataFrame, keep: Sequence[Column]) -> list[str]:
    return rows.select(*keep).columns


def empty_holds() -> Column:
    return F.array().cast(HOLD_EVENTS)

