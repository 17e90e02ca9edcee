"""Rule sets, event records, on-hold periods and run reports."""

import json
from dataclasses import replace

from pyspark.sql import functions as F

from casetrail.operators.codes import process_block
from casetrail.operators.events import HOLD_EVENTS, PROCESS_EVENTS, RecordSpec, build_records, record_json
from casetrail.operators.facets import Facets
from casetrail.operators.holds import grouped_holds, hold_event_rows
from casetrail.operators.report import run_summary
from casetrail.operators.rules import Rule, compile_test, match_column, missing_columns, parse_hold_rules, parse_rules
from casetrail.plans import event_sets
from casetrail.session import scratch_path
from casetrail.sources import jsonl, tables

from . import shapes
from .registry import query, with_shapes

RAW_RULES = {
    "APPLICATION_RECEIVED": {
        "code_set": "APPLICATION/SUBMISSION/RECEIVED",
        "start_date": {"attr": "RECEIVED"},
        "logic": {"and": [{"op": "not_null", "attr": "RECEIVED"}]},
    },
    "UNDER_REVIEW": {
        "start_date": {"attr": "RECEIVED"}, "end_date": {"attr": "DECIDED"},
        "logic": {"and": [
            {"op": "in", "attr": "STATUS", "value": ["O", "P"]},
            {"or": [{"op": ">", "attr": "FEE", "value": 100000}, {"op": "=", "attr": "PRIORITY", "value": "1-URGENT"}]},
        ]},
    },
    "DECISION_NOTED": {
        "class_path": "DECISION/NOTED",
        "start_attr": "NOTED", "end_attr": "DECIDED",
        "logic": {"and": [
            {"op": ">", "attr": "DECIDED", "other_attr": "RECEIVED"},
            {"op": "regex", "attr": "PRIORITY", "value": "^[12]-"},
        ]},
    },
    "CLOSED": {
        "start_date": {"attr": "decided"},
        "logic": {"or": [
            {"op": "=", "attr": "STATUS", "value": "F"},
            {"and": [{"op": "null", "attr": "STATUS"}, {"op": "not_null", "attr": "DECIDED"}]},
        ]},
    },
}
RULES = parse_rules(RAW_RULES)
LIFECYCLE = {
    "UNDER_REVIEW": ["APPLICATION", "UNDER_REVIEW"],
    "CLOSED": {
        "code_set": {"l1": "CLOSURE", "l2": "FILE_CLOSED"},
        "status": {"Status": "Closed", "status_code": "CL", "status_description": " "},
    },
}
RAW_HOLD_RULES = {
    "HOLD_CLIENT": {
        "code": "WAITING_ON_CLIENT",
        "start_date": {"attr": "ON_HOLD_START_DATE"}, "end_date": {"attr": "ON_HOLD_END_DATE"},
        "logic": {"and": [{"op": "in", "attr": "ATHN_ON_HOLD_REASON_CODE", "value": ["error", "click"]}]},
    },
    "HOLD_LEGAL": {
        "code": "LEGAL_REVIEW",
        "start_date": {"attr": "ON_HOLD_START_DATE"}, "end_date": {"attr": "ON_HOLD_END_DATE"},
        "logic": {"or": [
            {"op": "=", "attr": "ATHN_ON_HOLD_REASON_CODE", "value": "signup"},
            {"op": "<", "attr": "ON_HOLD_END_DATE", "other_attr": "ON_HOLD_START_DATE"},
        ]},
    },
}
HOLD_RULES = parse_hold_rules(RAW_HOLD_RULES)
RULESET = event_sets.Ruleset(RULES, HOLD_RULES)
SPEC = RecordSpec(
    id_column="PERMIT_ID",
    default_system_id="ITSM-5314",
    process_code_system="https://example.org/process",
    hold_code_system="https://example.org/hold",
    lifecycle=LIFECYCLE,
    hold_code_map={"WAITING_ON_CLIENT": {"code_display": "Waiting on client"}},
)

# Times of a permit as text, written out once more for the checking engine.
TIMES_SQL = """times AS (SELECT *,
    coalesce(nullif(trim(system_id), ''), 'ITSM-5314') AS sys,
    lower(trim(coalesce(STATUS, ''))) IN ('', 'null', 'nat') AS no_status,
    strftime(RECEIVED, '%Y-%m-%dT%H:%M:%SZ') AS r_time, strftime(RECEIVED, '%Y-%m-%d') AS r_day,
    strftime(DECIDED, '%Y-%m-%dT%H:%M:%SZ') AS d_time, strftime(DECIDED, '%Y-%m-%d') AS d_day,
    CASE PERMIT_ID % 6 WHEN 0 THEN replace(NOTED, ' ', 'T') || 'Z' WHEN 1 THEN NOTED || 'T00:00:00Z'
        WHEN 3 THEN substr(NOTED, 1, 10) || 'T08:00:00Z' WHEN 4 THEN NOTED || 'T00:00:00Z' END AS n_time,
    CASE WHEN PERMIT_ID % 6 IN (0, 1, 3) THEN substr(NOTED, 1, 10) END AS n_day,
    PERMIT_ID % 6 <> 4 AS n_real
  FROM permits)"""


def _event_sql(no: int, rule: str, code: str, where: str, s: str, e: str | None, real: str = "true") -> str:
    back = f"coalesce({real} AND {e}_time < {s}_time, false)" if e else "false"
    end_day = f"CASE WHEN {back} OR {e}_time IS NULL THEN {e}_day END" if e else "CAST(NULL AS VARCHAR)"
    end_time = f"CASE WHEN NOT {back} THEN {e}_time END" if e else "CAST(NULL AS VARCHAR)"
    return f"""SELECT CAST(PERMIT_ID AS VARCHAR) AS record_id, sys AS system_id, {no} AS rule_no, '{rule}' AS rule,
        '{code}' AS code, CASE WHEN {back} OR {s}_time IS NULL THEN {s}_day END AS start_date,
        CASE WHEN NOT {back} THEN {s}_time END AS start_datetime, {end_day} AS end_date, {end_time} AS end_datetime
    FROM times WHERE {where}"""


WHERE = {
    "APPLICATION_RECEIVED": "RECEIVED IS NOT NULL",
    "UNDER_REVIEW": "NOT no_status AND STATUS IN ('O', 'P') AND (FEE > 100000 OR PRIORITY = '1-URGENT')",
    "DECISION_NOTED": "DECIDED > RECEIVED AND regexp_matches(PRIORITY, '^[12]-')",
    "CLOSED": "(NOT no_status AND STATUS = 'F') OR (no_status AND DECIDED IS NOT NULL)",
}
EVENTS_SQL = "\nUNION ALL\n".join([
    _event_sql(0, "APPLICATION_RECEIVED", "RECEIVED", WHERE["APPLICATION_RECEIVED"], "r", None),
    _event_sql(1, "UNDER_REVIEW", "UNDER_REVIEW", WHERE["UNDER_REVIEW"], "r", "d"),
    _event_sql(2, "DECISION_NOTED", "NOTED", WHERE["DECISION_NOTED"], "n", "d", "n_real"),
    _event_sql(3, "CLOSED", "FILE_CLOSED", WHERE["CLOSED"], "d", None),
])


def permits_sql(body: str, *ctes: str, **shaped: str) -> str:
    """Checking SQL over permits with their times."""
    head = with_shapes("", permits=shapes.PERMITS, **shaped).rstrip()
    return ",\n".join([head, TIMES_SQL, *ctes]) + "\n" + body


def permits(t):
    return t.shape(shapes.PERMITS)


def holds(t):
    return t.shape(shapes.HOLDS)


@query(permits_sql(EVENTS_SQL))
def process_event_rows(t):
    return event_sets.process_event_rows(permits(t), RULES, SPEC)


@query(permits_sql(
    """SELECT record_id, rule, coalesce(start_date, substr(start_datetime, 1, 10)) AS start_date,
        CAST(NULL AS VARCHAR) AS start_datetime, coalesce(end_date, substr(end_datetime, 1, 10)) AS end_date
    FROM (""" + EVENTS_SQL.replace("n_time", "(CASE WHEN n_real THEN n_time END)") + ")"))
def process_event_rows_by_date(t):
    rows = event_sets.process_event_rows(permits(t), RULES, replace(SPEC, time_mode="DATE"))
    return rows.select("record_id", "rule", "start_date", "start_datetime", "end_date")


TEXT_TESTS = {
    "is_null": {"op": "null", "attr": "STATUS"},
    "is_not_null": {"op": "not_null", "attr": "STATUS"},
    "text_equal": {"op": "=", "attr": "STATUS", "value": "O"},
    "text_unequal": {"op": "!=", "attr": "STATUS", "value": "O"},
    "text_after": {"op": ">", "attr": "NOTED", "value": "a"},
    "text_not_after": {"op": "<=", "attr": "PRIORITY", "value": "3"},
    "date_text_unequal": {"op": "!=", "attr": "NOTED", "value": "soon"},
    "invalid_date_is_text": {"op": "=", "attr": "NOTED", "value": "2020-13-45"},
    "date_text_never_in_list": {"op": "in", "attr": "NOTED", "value": ["soon", "10:30", "1998-10-03"]},
    "in_text": {"op": "in", "attr": "STATUS", "value": "OFX"},
    "number_above": {"op": ">", "attr": "FEE", "value": 250000},
    "number_at_least": {"op": ">=", "attr": "PERMIT_ID", "value": 7000},
    "number_below": {"op": "<", "attr": "FEE", "value": 1234.5},
    "number_equal": {"op": "=", "attr": "PERMIT_ID", "value": 12},
    "number_in_list": {"op": "in", "attr": "PERMIT_ID", "value": [1, 2, 3, "4"]},
    "number_is_no_text": {"op": "!=", "attr": "FEE", "value": "5"},
    "instant_is_no_text": {"op": "=", "attr": "RECEIVED", "value": "1998-10-03"},
    "instants_in_order": {"op": "<=", "attr": "RECEIVED", "other_attr": "DECIDED"},
    "text_equals_instant": {"op": "=", "attr": "NOTED", "other_attr": "RECEIVED"},
    "texts_compared": {"op": "<", "attr": "STATUS", "other_attr": "PRIORITY"},
    "pattern": {"op": "regex", "attr": "PRIORITY", "value": "URG|LOW"},
    "pattern_on_date_text": {"op": "regex", "attr": "NOTED", "value": "^[0-9-]{10} 00"},
    "pattern_on_instant": {"op": "regex", "attr": "RECEIVED", "value": "00:00:00$"},
    "missing_column": {"op": "=", "attr": "NO_SUCH_COLUMN", "value": "x"},
    "missing_column_is_null": {"op": "null", "attr": "NO_SUCH_COLUMN"},
    "empty_literal": {"op": "=", "attr": "STATUS", "value": " null "},
}


@query(permits_sql(
    """SELECT PERMIT_ID, no_status AS is_null, NOT no_status AS is_not_null,
        NOT no_status AND STATUS = 'O' AS text_equal, NOT no_status AND STATUS <> 'O' AS text_unequal,
        PERMIT_ID % 6 = 5 AS text_after, PRIORITY <= '3' AS text_not_after,
        PERMIT_ID % 6 <> 5 AS date_text_unequal, PERMIT_ID % 6 = 4 AS invalid_date_is_text,
        PERMIT_ID % 6 IN (2, 5) AS date_text_never_in_list, NOT no_status AND STATUS IN ('O', 'F') AS in_text,
        FEE > 250000 AS number_above, PERMIT_ID >= 7000 AS number_at_least, FEE < 1234.5 AS number_below,
        PERMIT_ID = 12 AS number_equal, PERMIT_ID IN (1, 2, 3) AS number_in_list, true AS number_is_no_text,
        false AS instant_is_no_text, coalesce(RECEIVED <= DECIDED, false) AS instants_in_order,
        PERMIT_ID % 6 IN (0, 1) AND RECEIVED IS NOT NULL AS text_equals_instant,
        NOT no_status AND STATUS < PRIORITY AS texts_compared,
        regexp_matches(PRIORITY, 'URG|LOW') AS pattern, PERMIT_ID % 6 IN (0, 1, 3) AS pattern_on_date_text,
        RECEIVED IS NOT NULL AS pattern_on_instant, false AS missing_column, true AS missing_column_is_null,
        false AS empty_literal
    FROM times"""))
def rule_operators(t):
    rows = permits(t)
    facets = Facets(rows.schema)
    tests = {name: compile_test(test, facets).holds for name, test in TEXT_TESTS.items()}
    return facets.project(rows).select("PERMIT_ID", *[c.alias(name) for name, c in tests.items()])


# Names as the permits have them; each pattern has something that the two matchers read differently.
NAMED = """SELECT event_id AS PERMIT_ID, CASE event_id % 8 WHEN 0 THEN 'Montréal' WHEN 1 THEN 'Montreal' WHEN 2 THEN 'Tŝilhqot''in'
    WHEN 3 THEN 'xʷməθkʷəy̓əm' WHEN 4 THEN '٣٤' WHEN 5 THEN 'Ville de Québec' WHEN 6 THEN 'QUÉBEC 12' ELSE 'bb aa' || chr(160) || 'b' END AS NAME
    FROM {events}"""
PATTERN_TESTS = {
    "one_word": (r"^\w+$", (0, 1, 4)), "digits": (r"^\d+\Z", (4,)), "word_end": (r"l\b", (0, 1)), "no_word": (r"[^\w\s]", (2, 3)),
    "space": (r"\s", (5, 6, 7)), "any_case": (r"(?i)québec\b", (5, 6)), "doubled": (r"(?P<c>\w)(?P=c)", (5, 7)), "ascii": (r"(?a)^\w+$", (1,)),
    "verbose": (r"(?x) ^ v | ^ V i  # ville", (5,)), "not_first": (r"(?<!^)M|\BQ|b$", (7,)),
}


@query(with_shapes(
    "SELECT PERMIT_ID, " + ", ".join(f"PERMIT_ID % 8 IN {found}" .replace(",)", ")") + f" AS {name}" for name, (_, found) in PATTERN_TESTS.items())
    + " FROM named", named=NAMED))
def rule_patterns(t):
    """Rules' patterns find what the matcher they were written for finds."""
    rows = t.shape(NAMED)
    facets = Facets(rows.schema)
    tests = {name: compile_test({"op": "regex", "attr": "NAME", "value": pattern}, facets).holds for name, (pattern, _) in PATTERN_TESTS.items()}
    return facets.project(rows).select("PERMIT_ID", *[c.alias(name) for name, c in tests.items()])


_HIGH, _OPEN = {"op": ">", "attr": "FEE", "value": 250000}, {"op": "=", "attr": "STATUS", "value": "O"}
_FAILING = {"op": "regex", "attr": "PRIORITY", "other_attr": "STATUS"}
TREES = {
    "empty_and": {"and": []},
    "empty_or": {"or": []},
    "and_wins": {"and": [_OPEN], "or": [_HIGH]},
    "nested": {"or": [{"and": [_HIGH, _OPEN]}, {"and": [{"op": "regex", "attr": "PRIORITY", "value": "^5"}, {"or": [_OPEN]}]}]},
    "failing_first": {"or": [_FAILING, _HIGH]},
    "failing_last": {"or": [_HIGH, _FAILING]},
    "failing_skipped": {"and": [_HIGH, {"or": [_OPEN, _FAILING]}]},
}


@query(permits_sql(
    """SELECT PERMIT_ID, true AS empty_and, false AS empty_or, is_open AS and_wins,
        (high AND is_open) OR (PRIORITY LIKE '5%' AND is_open) AS nested,
        no_status AND high AS failing_first, high AS failing_last, high AND is_open AS failing_skipped
    FROM (SELECT *, FEE > 250000 AS high, NOT no_status AND STATUS = 'O' AS is_open FROM times)"""))
def rule_trees(t):
    rows = permits(t)
    facets = Facets(rows.schema)
    trees = {name: match_column(Rule(name, tree), facets) for name, tree in TREES.items()}
    return facets.project(rows).select("PERMIT_ID", *[c.alias(name) for name, c in trees.items()])


@query(permits_sql(
    """SELECT o_orderkey, code, code_display, codes, status, status_code, status_description
    FROM orders, (VALUES
        ('RECEIVED', 'Received', 'APPLICATION/SUBMISSION/RECEIVED', NULL, NULL, NULL),
        ('UNDER_REVIEW', 'Under Review', 'APPLICATION/UNDER_REVIEW', NULL, NULL, NULL),
        ('NOTED', 'Noted', 'DECISION/NOTED', NULL, NULL, NULL),
        ('FILE_CLOSED', 'File Closed', 'CLOSURE/FILE_CLOSED', 'Closed', 'CL', NULL)
    ) AS c(code, code_display, codes, status, status_code, status_description)
    WHERE CASE o_orderkey % 4 WHEN 0 THEN 'RECEIVED' WHEN 1 THEN 'UNDER_REVIEW' WHEN 2 THEN 'NOTED'
          ELSE 'FILE_CLOSED' END = code"""))
def process_codes(t):
    """Code blocks of the rules, each order carrying the block of one rule."""
    blocks = F.array(*[process_block(r, LIFECYCLE, "https://example.org/process") for r in RULES])
    return t.table("orders").select("o_orderkey", F.get(blocks, F.col("o_orderkey") % 4).alias("b")).select(
        "o_orderkey", "b.code", "b.code_display", F.concat_ws("/", "b.code_set").alias("codes"),
        "b.status", "b.status_code", "b.status_description",
    )


def _field(name: str, column: str) -> str:
    return f"""'"{name}":"' || {column} || '"'"""


EVENT_JSON = "'{\"event\":{' || concat_ws(',', " + ", ".join(
    _field(n, n) for n in ("start_date", "start_datetime", "end_date", "end_datetime")) + ") || '}'"
PROCESS_JSON = """CASE rule_no
    WHEN 0 THEN '"code":"RECEIVED","code_display":"Received","code_set":["APPLICATION","SUBMISSION","RECEIVED"],"code_system":"https://example.org/process"'
    WHEN 1 THEN '"code":"UNDER_REVIEW","code_display":"Under Review","code_set":["APPLICATION","UNDER_REVIEW"],"code_system":"https://example.org/process"'
    WHEN 2 THEN '"code":"NOTED","code_display":"Noted","code_set":["DECISION","NOTED"],"code_system":"https://example.org/process"'
    ELSE '"code":"FILE_CLOSED","code_display":"File Closed","code_set":["CLOSURE","FILE_CLOSED"],"code_system":"https://example.org/process","status":"Closed","status_code":"CL"'
    END"""
PROCESS_SETS = f"""process_sets AS (SELECT record_id, any_value(system_id) AS sys,
    string_agg({EVENT_JSON} || ',"process":{{' || {PROCESS_JSON} || '}}}}', ',' ORDER BY rule_no) AS events
  FROM ({EVENTS_SQL}) GROUP BY record_id)"""
HOLD_EVENTS_CTE = """hold_rows AS (SELECT CAST(AUTHORIZATION_ID AS VARCHAR) AS key, AUTHORIZATION_ON_HOLD_ID AS no,
    ATHN_ON_HOLD_REASON_CODE AS reason, ON_HOLD_START_DATE AS s, ON_HOLD_END_DATE AS e,
    coalesce(ON_HOLD_END_DATE < ON_HOLD_START_DATE, false) AS back,
    coalesce(date_trunc('second', ON_HOLD_END_DATE) < date_trunc('second', ON_HOLD_START_DATE), false) AS back_s
  FROM holds),
hold_matches AS (
  SELECT *, 0 AS rule_pos, 'WAITING_ON_CLIENT' AS code, 'Waiting on client' AS code_display FROM hold_rows
    WHERE reason IN ('error', 'click')
  UNION ALL
  SELECT *, 1 AS rule_pos, 'LEGAL_REVIEW' AS code, 'Legal Review' AS code_display FROM hold_rows
    WHERE reason = 'signup' OR back),
hold_events AS (SELECT key, rule_pos, code, code_display,
    CASE WHEN date_trunc('second', s) = s THEN strftime(s, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(s, '%Y-%m-%d %H:%M:%S.%f') END AS started,
    CAST(no AS VARCHAR) AS hold_id,
    CASE WHEN back_s THEN strftime(s, '%Y-%m-%d') END AS start_date,
    CASE WHEN NOT back_s THEN strftime(s, '%Y-%m-%dT%H:%M:%SZ') END AS start_datetime,
    CASE WHEN back_s THEN strftime(e, '%Y-%m-%d') END AS end_date,
    CASE WHEN NOT back_s THEN strftime(e, '%Y-%m-%dT%H:%M:%SZ') END AS end_datetime
  FROM hold_matches WHERE s IS NOT NULL)"""
HOLD_SETS = f"""hold_sets AS (SELECT key, string_agg({EVENT_JSON} || ',"coding":{{"code":"' || code
    || '","code_display":"' || code_display || '","code_set":["' || code
    || '"],"code_system":"https://example.org/hold"}}}}', ',' ORDER BY started, hold_id, rule_pos) AS hold_json
  FROM hold_events GROUP BY key)"""


def _line_sql(holds_json: str) -> str:
    return f"""'{{"transaction_id":"-","version":"0.1.0","kind":"Record","system_id":"' || sys || '","record_id":'
        || record_id || ',"record_kind":"Permit","on_hold_event_set":[' || {holds_json}
        || '],"process_event_set":[' || coalesce(events, '') || ']}}' AS value"""


@query(permits_sql(f"SELECT record_id, {_line_sql(chr(39) * 2)} FROM process_sets", PROCESS_SETS))
def event_set_lines(t):
    """Records as JSON texts; the id that differs on every run is replaced."""
    return record_json(event_sets.event_set(permits(t), RULES, SPEC), F.lit("-"))


@query(permits_sql(
    f"SELECT * FROM (SELECT record_id, {_line_sql(chr(39) * 2)} FROM process_sets) WHERE false "
    f"""UNION ALL SELECT CAST(PERMIT_ID AS VARCHAR) AS record_id, {_line_sql("coalesce(hold_json, '')")}
    FROM (SELECT p.PERMIT_ID, p.sys, CAST(p.PERMIT_ID AS VARCHAR) AS record_id, x.events, h.hold_json FROM times p
          LEFT JOIN process_sets x ON x.record_id = CAST(p.PERMIT_ID AS VARCHAR)
          LEFT JOIN hold_sets h ON h.key = regexp_replace(trim(p.AUTHORIZATION_ID), '[.]0$', ''))
    WHERE events IS NOT NULL OR hold_json IS NOT NULL""",
    PROCESS_SETS, HOLD_EVENTS_CTE, HOLD_SETS, holds=shapes.HOLDS))
def event_set_with_holds_lines(t):
    """Flagship: process events and on-hold periods of every permit, one JSON text each."""
    return record_json(event_sets.event_set_with_holds(permits(t), holds(t), RULESET, SPEC), F.lit("-"))


HOLD_MATCH_FROM = """FROM times p JOIN hold_events h ON h.key = regexp_replace(trim(p.AUTHORIZATION_ID), '[.]0$', '')"""


@query(permits_sql(
    "SELECT CAST(PERMIT_ID AS VARCHAR) AS record_id, sys AS system_id, started, hold_id, code, code_display, "
    "start_date, start_datetime, end_date, end_datetime " + HOLD_MATCH_FROM,
    HOLD_EVENTS_CTE, holds=shapes.HOLDS))
def hold_event_matches(t):
    return event_sets.hold_event_matches(permits(t), holds(t), HOLD_RULES, SPEC)


@query(permits_sql(
    """SELECT key, count(*) AS events, string_agg(code || '@' || coalesce(start_datetime, start_date), '|'
        ORDER BY started, hold_id, rule_pos) AS sequence FROM hold_events GROUP BY key""",
    HOLD_EVENTS_CTE, holds=shapes.HOLDS))
def ordered_holds_per_key(t):
    grouped = grouped_holds(hold_event_rows(holds(t), HOLD_RULES, SPEC))
    step = F.transform("on_hold_event_set", lambda e: F.concat(
        e["coding"]["code"], F.lit("@"), F.coalesce(e["event"]["start_datetime"], e["event"]["start_date"])))
    return grouped.select(
        F.col("__hold_key").alias("key"), F.size("on_hold_event_set").cast("bigint").alias("events"),
        F.array_join(step, "|").alias("sequence"),
    )


@query(permits_sql(
    """SELECT CAST(CAST(key AS BIGINT) % 3 AS VARCHAR) AS key, count(*) AS events,
        string_agg(code || '@' || coalesce(start_datetime, start_date), '|' ORDER BY started, hold_id, rule_pos, code,
            coalesce(start_datetime, start_date)) AS sequence
    FROM hold_events GROUP BY ALL""",
    HOLD_EVENTS_CTE, holds=shapes.HOLDS))
def heavy_keys_in_order(t):
    """All holds under three keys: a key with a third of all rows keeps every event, in order, in one list."""
    few = holds(t).withColumn("AUTHORIZATION_ID", F.col("AUTHORIZATION_ID") % 3)
    grouped = grouped_holds(hold_event_rows(few, HOLD_RULES, SPEC))
    step = F.transform("on_hold_event_set", lambda e: F.concat(
        e["coding"]["code"], F.lit("@"), F.coalesce(e["event"]["start_datetime"], e["event"]["start_date"])))
    return grouped.select(
        F.col("__hold_key").alias("key"), F.size("on_hold_event_set").cast("bigint").alias("events"),
        F.array_join(step, "|").alias("sequence"),
    )


@query("""SELECT o_orderkey, '{"transaction_id":"-","version":"0.1.0","kind":"Record","system_id":"ITSM-5314","record_id":'
    || repeat('1234567890', 4) || CAST(o_orderkey AS VARCHAR)
    || ',"record_kind":"Permit","on_hold_event_set":[],"process_event_set":[]}' AS value FROM orders""")
def long_record_ids(t):
    """Ids of more than 40 digits stay whole in the line."""
    rows = t.table("orders").select(
        "o_orderkey", F.concat(F.lit("1234567890" * 4), F.col("o_orderkey").cast("string")).alias("PERMIT_ID"),
        F.array().cast(HOLD_EVENTS).alias("on_hold_event_set"), F.array().cast(PROCESS_EVENTS).alias("process_event_set"),
    )
    spec = replace(SPEC, default_system_id="ITSM-5314")
    made = record_json(build_records(rows, spec), F.lit("-"))
    return made.select(F.right(F.col("record_id"), F.length("record_id") - 40).try_cast("bigint").alias("o_orderkey"), "value")


def _hits(counts: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {i} AS rule_no, '{rule}' AS rule, (SELECT count(*) FROM {body}) AS hits"
        for i, (rule, body) in enumerate(counts.items())
    )


@query(permits_sql(_hits({rule: f"times WHERE {where}" for rule, where in WHERE.items()})))
def process_rule_hits(t):
    return event_sets.process_hit_report(permits(t), RULES)


@query(permits_sql(
    _hits({
        rule: f"times p JOIN hold_matches h ON h.key = regexp_replace(trim(p.AUTHORIZATION_ID), '[.]0$', '') "
              f"WHERE rule_pos = {i}"
        for i, rule in enumerate(("HOLD_CLIENT", "HOLD_LEGAL"))
    }), HOLD_EVENTS_CTE, holds=shapes.HOLDS))
def hold_rule_hits(t):
    return event_sets.hold_hit_report(permits(t), holds(t), HOLD_RULES)


@query(permits_sql(
    f"""SELECT source_rows, output_records, process_events, on_hold_events,
        process_events + on_hold_events AS total_events FROM (SELECT
      (SELECT count(*) FROM times) AS source_rows,
      (SELECT count(*) FROM times p WHERE CAST(PERMIT_ID AS VARCHAR) IN (SELECT record_id FROM process_sets)
          OR regexp_replace(trim(p.AUTHORIZATION_ID), '[.]0$', '') IN (SELECT key FROM hold_events)) AS output_records,
      (SELECT count(*) FROM ({EVENTS_SQL})) AS process_events,
      (SELECT count(*) {HOLD_MATCH_FROM}) AS on_hold_events)""",
    PROCESS_SETS, HOLD_EVENTS_CTE, holds=shapes.HOLDS))
def run_totals(t):
    rows = permits(t)
    return run_summary(rows, event_sets.event_set_with_holds(rows, holds(t), RULESET, SPEC))


def _job(t, with_holds: bool, **options):
    """A job run from stored tables and rule files: its files and its result."""
    folder = scratch_path(t.spark, "job")

    def stored(name: str, content) -> str:
        path = f"{folder}/{name}"
        if isinstance(content, dict):
            t.spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(path)
        else:
            tables.replace_files(content, path)
        return path

    files = event_sets.JobFiles(
        permits=stored("permits", permits(t)), rules=stored("rules.json", RAW_RULES), lifecycle=stored("lifecycle.json", LIFECYCLE),
        output=f"{folder}/out.jsonl",
    )
    if with_holds:
        files = replace(
            files, holds=stored("holds", holds(t)), hold_rules=stored("hold_rules.json", RAW_HOLD_RULES),
            hold_code_map=stored("codes.json", dict(SPEC.hold_code_map)),
        )
    return files, event_sets.run_job(t.spark, files, SPEC, **options)


def _lines_read(t, files):
    """Lines as they were stored, the id that differs on every run replaced."""
    value = F.regexp_replace("value", '^\\{"transaction_id":"[^"]*"', '{"transaction_id":"-"')
    return jsonl.read_lines(t.spark, files.output).select(
        F.regexp_extract("value", '"record_id":"?([^",]*)', 1).alias("record_id"), value.alias("value")
    )


@query(permits_sql(f"SELECT record_id, {_line_sql(chr(39) * 2)} FROM process_sets", PROCESS_SETS))
def job_lines(t):
    """A job without holds, from rule files to stored lines."""
    return _lines_read(t, _job(t, False)[0])


@query(permits_sql(
    f"""SELECT CAST(PERMIT_ID AS VARCHAR) AS record_id, {_line_sql("coalesce(hold_json, '')")}
    FROM (SELECT p.PERMIT_ID, p.sys, CAST(p.PERMIT_ID AS VARCHAR) AS record_id, x.events, h.hold_json FROM times p
          LEFT JOIN process_sets x ON x.record_id = CAST(p.PERMIT_ID AS VARCHAR)
          LEFT JOIN hold_sets h ON h.key = regexp_replace(trim(p.AUTHORIZATION_ID), '[.]0$', ''))
    WHERE events IS NOT NULL OR hold_json IS NOT NULL""",
    PROCESS_SETS, HOLD_EVENTS_CTE, HOLD_SETS, holds=shapes.HOLDS))
def job_with_holds_lines(t):
    """A job with holds, from rule files to stored lines."""
    return _lines_read(t, _job(t, True)[0])


_JOB_HITS = " UNION ALL ".join([
    *[f"SELECT '{rule}' AS name, count(*) AS n FROM times WHERE {where}" for rule, where in WHERE.items()],
    *[f"SELECT '{rule}' AS name, count(*) AS n FROM times p JOIN hold_matches h "
      f"ON h.key = regexp_replace(trim(p.AUTHORIZATION_ID), '[.]0$', '') WHERE rule_pos = {i}"
      for i, rule in enumerate(RAW_HOLD_RULES)],
])


@query(permits_sql(
    f"""{_JOB_HITS} UNION ALL SELECT 'source rows' AS name, count(*) AS n FROM times
    UNION ALL SELECT 'process events' AS name, count(*) AS n FROM ({EVENTS_SQL})
    UNION ALL SELECT 'on-hold events' AS name, count(*) AS n {HOLD_MATCH_FROM}
    UNION ALL SELECT 'lines' AS name, count(*) AS n FROM times p
      WHERE CAST(PERMIT_ID AS VARCHAR) IN (SELECT record_id FROM process_sets)
         OR regexp_replace(trim(p.AUTHORIZATION_ID), '[.]0$', '') IN (SELECT key FROM hold_events)""",
    PROCESS_SETS, HOLD_EVENTS_CTE, holds=shapes.HOLDS))
def job_with_holds_totals(t):
    """What a job's only pass has counted."""
    done = _job(t, True, fail_on_empty=True)[1]
    counts = [
        *done.process_hits, *done.hold_hits, ("source rows", done.source_rows), ("process events", done.process_events),
        ("on-hold events", done.on_hold_events), ("lines", done.lines),
    ]
    return t.spark.createDataFrame(counts, "name string, n bigint")


@query(permits_sql("SELECT least(count(*), 1000) AS source_rows FROM times"))
def trial_job_rows(t):
    """A trial run reads no more rows than it may; which ones is left open."""
    done = _job(t, False, max_rows=1000)[1]
    return t.table("orders").select(F.lit(done.source_rows).cast("bigint").alias("source_rows")).limit(1)


@query(permits_sql(_hits({rule: f"times WHERE {where}" for rule, where in WHERE.items() if rule != "UNDER_REVIEW"})))
def hits_of_one_source(t):
    """Rules of another source are left out; those that name none always count."""
    named = {k: v | {"source": {"UNDER_REVIEW": "lands", "CLOSED": "WATER"}[k]} if k in ("UNDER_REVIEW", "CLOSED") else v for k, v in RAW_RULES.items()}
    return event_sets.process_hit_report(permits(t), parse_rules(named, "water"))


@query(permits_sql("SELECT 'NO_SUCH_COLUMN' AS name, count(*) AS rows_read_as_null FROM times"))
def columns_rules_lack(t):
    """Columns that rules read and the table lacks, and the rows for which they read as NULL."""
    rows = permits(t)
    lacking = parse_rules(RAW_RULES | {"X": {"start_attr": "NO_SUCH_COLUMN", "logic": {"and": []}}})
    names = F.explode(F.array(*[F.lit(c) for c in missing_columns(rows, lacking, ("permit_id",))]))
    return rows.select(names.alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("rows_read_as_null"))
