"""Event-set jobs: staged rows and rules in, one event record per permit out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.events import (
    PROCESS_EVENTS, RecordSpec, build_records, empty_holds, event_array, flat_events, process_events,
    record_id, record_json, rows_with_events, system_id,
)
from ..operators.facets import Facets
from ..operators.holds import (
    PERMIT_KEY_COLUMNS, attach_holds, grouped_hold_hits, grouped_holds, hold_event_rows, hold_hits,
    matched_hold_events,
)
from ..operators.report import TOP_RULES, hit_report, packed_hits, rule_hits, run_summary, unpacked_hits
from ..operators.rules import Rule, match_column, missing_columns
from ..schemas import quoted
from ..session import prepare
from ..sources import config, jsonl, tables


# Columns that carry a permit's rule matches over the join with its holds.
_MATCHES = "__matches_"


@dataclass(frozen=True)
class Job:
    """A named event-set job: where its rows are staged, and its system id."""

    staging: str
    default_system_id: str
    with_holds: bool = False


# The event-set jobs and the system ids of their records.
JOBS: dict[str, Job] = {
    "water authorization": Job("water authorization", "ITSM-5314"),
    "water job number": Job("water job number", "ITSM-6197"),
    "water tracking": Job("water tracking", "ITSM-6117"),
    "lands": Job("lands", "ITSM-6072"),
    "water authorization, holds": Job("water authorization", "ITSM-5314", True),
    "water job number, holds": Job("water job number", "ITSM-6197", True),
    "water tracking, holds": Job("water tracking", "ITSM-6117", True),
    "lands, holds": Job("lands", "ITSM-6072", True),
    "lands applications, holds": Job("lands applications", "ITSM-6117", True),
}


@dataclass(frozen=True)
class Ruleset:
    """Process rules and, for jobs with holds, the hold rules."""

    process: Sequence[Rule]
    holds: Sequence[Rule] = field(default_factory=tuple)


def with_process_events(permits: DataFrame, rules: Sequence[Rule], spec: RecordSpec,
                        keep: Sequence[Column], only_matched: bool = False,
                        seen: Observation | None = None, carry: str | None = None) -> DataFrame:
    """Permits with the array of their process events, in rule order. No shuffle.

    ``seen`` is told the rows read (``source_rows``) and the matches of each rule (``hit_0`` and so on). Where a shuffle
    follows, ``carry`` names columns for the matches instead, to be counted behind it.
    """
    facets = Facets(permits.schema)
    events = event_array(process_events(rules, facets, spec), PROCESS_EVENTS)
    matches = packed_hits(rules, facets, carry) if carry else {}
    rows = facets.project(permits)
    keep = [*keep, *[bits.alias(name) for name, bits in matches.items()]]
    if seen is not None:
        hits = [F.count_if(match_column(rule, facets)).alias(f"hit_{i}") for i, rule in enumerate(rules)]
        rows = rows.observe(seen, F.count(F.lit(1)).alias("source_rows"), *hits)
    if only_matched:
        return rows_with_events(rows, keep, events, "process_event_set")
    return rows.select(*keep, events.alias("process_event_set"))


def event_set(permits: DataFrame, rules: Sequence[Rule], spec: RecordSpec,
              seen: Observation | None = None) -> DataFrame:
    """Records with process events only; the set of holds is empty."""
    keep = _columns(permits, (spec.id_column, spec.system_column))
    rows = with_process_events(permits, rules, spec, keep, only_matched=True, seen=seen)
    return build_records(rows.withColumn("on_hold_event_set", empty_holds()), spec)


def event_set_with_holds(permits: DataFrame, holds: DataFrame, rules: Ruleset, spec: RecordSpec,
                         candidates: Sequence[str] = PERMIT_KEY_COLUMNS,
                         seen: Observation | None = None, holds_seen: Observation | None = None) -> DataFrame:
    """Records with process events and the on-hold periods of the permit's authorization.

    Only the id, the system id, the key and the events cross the join. ``holds_seen`` is told the matches of each hold
    rule (``hit_0`` and so on) over all permit and hold pairs. Both observations stand behind the join, in the stage that
    writes the records, so a map task that runs again is not counted twice.
    """
    keep = _columns(permits, (spec.id_column, spec.system_column, *candidates))
    rows = with_process_events(permits, rules.process, spec, keep, carry=_MATCHES if seen is not None else None)
    if holds_seen is None or not rules.holds:
        joined = attach_holds(rows, grouped_holds(hold_event_rows(holds, rules.holds, spec)), candidates)
    else:
        names = [f"hit_{i}" for i in range(len(rules.holds))]
        joined = attach_holds(rows, grouped_hold_hits(holds, rules.holds, spec), candidates)
        joined = joined.observe(holds_seen, *[F.sum(n).alias(n) for n in names]).drop(*names)
    if seen is not None:
        joined = joined.observe(seen, F.count(F.lit(1)).alias("source_rows"), *unpacked_hits(rules.process, _MATCHES))
    any_event = (F.size("process_event_set") + F.size("on_hold_event_set")) > 0
    return build_records(joined.filter(any_event), spec)


def _columns(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """The named columns the table has."""
    wanted = {n.lower() for n in names}
    return [F.col(quoted(c)) for c in df.columns if c.lower() in wanted]


def process_event_rows(permits: DataFrame, rules: Sequence[Rule], spec: RecordSpec) -> DataFrame:
    """One flat row per process event."""
    facets = Facets(permits.schema)
    return flat_events(
        permits, facets, process_events(rules, facets, spec), rules,
        [record_id(permits, spec)[0].alias("record_id"), system_id(permits, spec).alias("system_id")],
        "process",
    )


def hold_event_matches(permits: DataFrame, holds: DataFrame, rules: Sequence[Rule], spec: RecordSpec,
                       candidates: Sequence[str] = PERMIT_KEY_COLUMNS) -> DataFrame:
    """One flat row per permit and on-hold event; the form to use where keys are very heavy."""
    matched = matched_hold_events(
        permits, hold_event_rows(holds, rules, spec),
        [record_id(permits, spec)[0].alias("record_id"), system_id(permits, spec).alias("system_id")],
        candidates,
    )
    return matched.select(
        "record_id", "system_id", "started", "hold_id",
        F.col("coding.code").alias("code"), F.col("coding.code_display").alias("code_display"),
        "event.start_date", "event.start_datetime", "event.end_date", "event.end_datetime",
    )


def process_hit_report(permits: DataFrame, rules: Sequence[Rule], top: int = TOP_RULES) -> DataFrame:
    return hit_report(rule_hits(permits, rules), rules, top)


def hold_hit_report(permits: DataFrame, holds: DataFrame, rules: Sequence[Rule], top: int = TOP_RULES,
                    candidates: Sequence[str] = PERMIT_KEY_COLUMNS) -> DataFrame:
    return hit_report(hold_hits(permits, holds, rules, candidates), rules, top)


@dataclass(frozen=True)
class JobFiles:
    """Where a job reads and writes.

    Records repeat the names and codes of their fields, so lines are stored compressed unless ``compression`` says "none".
    """

    permits: str
    rules: str
    output: str
    lifecycle: str | None = None
    holds: str | None = None
    hold_rules: str | None = None
    hold_code_map: str | None = None
    table_format: str = "parquet"
    compression: str = "gzip"


@dataclass(frozen=True)
class JobResult:
    """Lines written, columns the rules named in vain, and what the same pass has counted.

    ``process_hits`` and ``hold_hits`` have every rule with its matches, most hit first.
    """

    lines: int
    missing_permit_columns: list[str]
    missing_hold_columns: list[str]
    source_rows: int = 0
    process_events: int = 0
    on_hold_events: int = 0
    process_hits: tuple[tuple[str, int], ...] = ()
    hold_hits: tuple[tuple[str, int], ...] = ()

    @property
    def total_events(self) -> int:
        return self.process_events + self.on_hold_events


def run_job(spark: SparkSession, files: JobFiles, spec: RecordSpec, max_rows: int = 0,
            fail_on_empty: bool = False, source: str | None = None) -> JobResult:
    """Reads tables and rule files, writes the records as JSON lines, and counts on the way: each table is read once.

    ``max_rows`` bounds the input of a trial run; 0 reads everything. ``source`` leaves out rules of other sources.
    """
    prepare(spark)
    rules = Ruleset(config.read_rules(spark, files.rules, source), config.read_hold_rules(spark, files.hold_rules))
    spec = replace(
        spec,
        lifecycle=config.read_map(spark, files.lifecycle),
        hold_code_map=config.read_map(spark, files.hold_code_map, tolerant=True),
    )
    permits = tables.read_table(spark, files.permits, files.table_format)
    always = (spec.id_column, spec.system_column)
    missing_holds: list[str] = []
    rows = permits.limit(max_rows) if max_rows else permits
    seen, holds_seen, made = Observation(), Observation(), Observation()
    if files.holds:
        holds = tables.read_table(spark, files.holds, files.table_format)
        missing_holds = missing_columns(holds, rules.holds)
        records = event_set_with_holds(rows, holds, rules, spec, seen=seen, holds_seen=holds_seen)
    else:
        records = event_set(rows, rules.process, spec, seen=seen)
    records = records.observe(
        made, F.sum(F.size("process_event_set")).alias("process"), F.sum(F.size("on_hold_event_set")).alias("on_hold")
    )
    lines = jsonl.write_lines(record_json(records), files.output, fail_on_empty=fail_on_empty, compression=files.compression)
    counted, events = seen.get, made.get
    return JobResult(
        lines, missing_columns(permits, rules.process, always), missing_holds,
        counted.get("source_rows") or 0, events.get("process") or 0, events.get("on_hold") or 0,
        _most_hit(rules.process, counted),
        _most_hit(rules.holds, holds_seen.get if files.holds and rules.holds else {}),
    )


def run_named_job(spark: SparkSession, name: str, files: JobFiles, spec: RecordSpec, environment: str, day: date,
                  **options) -> JobResult:
    """One of ``JOBS``: its system id is the default, and ``files.output`` is the folder that the run's own goes to."""
    job = JOBS[name]
    if job.with_holds and not files.holds:
        raise ValueError(f"job '{name}' needs a table of holds")
    path = jsonl.output_path(files.output, name.replace(", ", "_").replace(" ", "_"), environment, day)
    files = replace(files, output=path, holds=files.holds if job.with_holds else None)
    return run_job(spark, files, replace(spec, default_system_id=job.default_system_id), **options)


def _most_hit(rules: Sequence[Rule], counts: Mapping[str, int]) -> tuple[tuple[str, int], ...]:
    hits = [(rule.key, counts.get(f"hit_{i}") or 0) for i, rule in enumerate(rules)]
    return tuple(sorted(hits, key=lambda h: -h[1]))


__all__ = [
    "JOBS", "Job", "JobFiles", "JobResult", "Ruleset", "event_set", "event_set_with_holds",
    "hold_event_matches", "hold_hit_report", "process_event_rows", "process_hit_report", "run_job",
    "run_named_job", "run_summary", "with_process_events",
]
