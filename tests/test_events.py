"""Event records: codes, times, ids, holds and whole jobs."""

import datetime as dt
import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from casetrail.operators.codes import resolve_codes
from casetrail.operators.events import RecordSpec, record_json
from casetrail.operators.report import EmptyOutput, hit_report, rule_hits
from casetrail.operators.rules import Rule, parse_hold_rules, parse_rules
from casetrail.plans import event_sets
from casetrail.sources import jsonl

SPEC = RecordSpec("PERMIT_ID", "ITSM-1", "https://example.org/p", "https://example.org/h")
ALWAYS = {"and": []}


@pytest.mark.parametrize(("code_set", "expected"), [
    ("A/B/ C ", ["A", "B", "C"]), ("A//B", ["A", "B"]), ("A/ /B", ["A", "", "B"]), ("", ["UNKNOWN"]),
    (["A", "", None, " B "], ["A", "B"]), ({"x": "A", "y": None}, ["A"]),
])
def test_codes_of_the_rule(code_set, expected):
    assert resolve_codes(Rule("R", ALWAYS, code_set=code_set), {"R": "ignored"}) == (expected, {})


@pytest.mark.parametrize(("entry", "expected"), [
    (None, (["UNKNOWN"], {})), ("A/B", (["A/B"], {})), (" ", (["UNKNOWN"], {})), (["A", "B"], (["A", "B"], {})),
    ({"class_path": "X", "STATUS": {"STATUS": "s"}}, (["X"], {"STATUS": "s"})),
    ({"code_set": {"a": "X", "b": "Y"}, "status": "no block"}, (["X", "Y"], {})), (5, (["UNKNOWN"], {})),
    ({"code_set": []}, (["UNKNOWN"], {})),
])
def test_codes_of_the_lifecycle(entry, expected):
    assert resolve_codes(Rule("R", ALWAYS), {"R": entry}) == expected


def lines(df):
    return [json.loads(r["value"]) for r in record_json(df).collect()]


def test_record_fields_and_ids(spark):
    ids = ["007", "12.9", "AB1", None, "9007199254740993"]
    df = spark.createDataFrame([(v, "2020-01-02", " " if i % 2 else "SYS") for i, v in enumerate(ids)],
                               "PERMIT_ID string, S string, system_id string")
    rules = parse_rules({"R": {"code_set": "A/B_C", "start_date": {"attr": "S"}, "logic": ALWAYS}})
    got = lines(event_sets.event_set(df, rules, SPEC))
    assert [r["record_id"] for r in got] == [7, 12, "AB1", "Error record_id", 9007199254740993]
    assert [r["system_id"] for r in got] == ["SYS", "ITSM-1", "SYS", "ITSM-1", "SYS"]
    assert list(got[0]) == [
        "transaction_id", "version", "kind", "system_id", "record_id", "record_kind", "on_hold_event_set",
        "process_event_set",
    ]
    assert got[0]["process_event_set"] == [{
        "event": {"start_datetime": "2020-01-02T00:00:00Z"},
        "process": {"code": "B_C", "code_display": "B C", "code_set": ["A", "B_C"], "code_system": "https://example.org/p"},
    }]
    assert got[0]["on_hold_event_set"] == []
    assert len({r["transaction_id"] for r in got}) == len(ids)


def test_codes_with_quotes_and_backslashes(spark):
    df = spark.createDataFrame([("1",)], "PERMIT_ID string")
    odd = r"IT'S_A\n \"CODE\" é"
    rules = parse_rules({"R": {"code_set": ["A", odd], "logic": ALWAYS}})
    process = lines(event_sets.event_set(df, rules, SPEC))[0]["process_event_set"][0]["process"]
    assert process["code"] == odd and process["code_set"] == ["A", odd]


TIME_ROWS = [
    ("2020-01-02 10:00:00", "2020-01-01 09:00:00", {"start_date": "2020-01-02", "end_date": "2020-01-01"}),
    ("2020-01-02", "2020-13-01", {"start_datetime": "2020-01-02T00:00:00Z", "end_datetime": "2020-13-01T00:00:00Z"}),
    ("2020-01-02 99:00", "2020-01-03", {"start_date": "2020-01-02", "end_datetime": "2020-01-03T00:00:00Z"}),
    (None, "2020-01-03", {"end_datetime": "2020-01-03T00:00:00Z"}),
    ("soon", "null", {}),
    ("2021-13-02", "2020-01-01", {"start_datetime": "2021-13-02T00:00:00Z", "end_datetime": "2020-01-01T00:00:00Z"}),
]


def test_time_blocks(spark):
    df = spark.createDataFrame([(str(i), s, e) for i, (s, e, _) in enumerate(TIME_ROWS)], "PERMIT_ID string, S string, E string")
    rules = parse_rules({"R": {"start_attr": "S", "end_attr": "E", "logic": ALWAYS}})
    got = {r["record_id"]: r["process_event_set"][0]["event"] for r in lines(event_sets.event_set(df, rules, SPEC))}
    assert got == {i: want for i, (_, _, want) in enumerate(TIME_ROWS)}
    by_day = lines(event_sets.event_set(df, rules, replace(SPEC, time_mode="DATE")))
    assert by_day[0]["process_event_set"][0]["event"] == {"start_date": "2020-01-02", "end_date": "2020-01-01"}
    assert by_day[1]["process_event_set"][0]["event"] == {"start_date": "2020-01-02"}


def test_rows_without_events_and_equal_ids(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", None)], "PERMIT_ID string, S string")
    rules = parse_rules({"R": {"logic": {"and": [{"op": "not_null", "attr": "S"}]}}})
    assert [r["record_id"] for r in lines(event_sets.event_set(df, rules, SPEC))] == [1, 1]


HOLD_RULES = parse_hold_rules({
    "H1": {"code": "C_ONE", "start_date": {"attr": "ON_HOLD_START_DATE"}, "end_date": {"attr": "ON_HOLD_END_DATE"},
           "logic": {"and": [{"op": "in", "attr": "ATHN_ON_HOLD_REASON_CODE", "value": ["1", "2"]}]}},
    "H2": {"code": "C_TWO", "start_date": {"attr": "ON_HOLD_START_DATE"},
           "logic": {"and": [{"op": "=", "attr": "ATHN_ON_HOLD_REASON_CODE", "value": "2"}]}},
})
T0 = dt.datetime(2020, 1, 1)


def hold_table(spark):
    return spark.createDataFrame(
        [(2, "1.0", "5", T0, None), (10, "2", "5.0", T0, T0), (3, " 2 ", " 5 ", None, T0), (4, "9", "5", T0, None),
         (5, "1", None, T0, None), (6, "1", "7", dt.datetime(2019, 1, 1), None), (7, "1", "null", T0, None)],
        """AUTHORIZATION_ON_HOLD_ID int, ATHN_ON_HOLD_REASON_CODE string, AUTHORIZATION_ID string,
           ON_HOLD_START_DATE timestamp_ntz, ON_HOLD_END_DATE timestamp_ntz""")


def permit_table(spark):
    return spark.createDataFrame(
        [("1", None, "5"), ("2", "7.000", "5"), ("3", "null", "6"), ("4", None, None), ("5", " ", "5")],
        "PERMIT_ID string, ATSAUTHORIZATIONNUMBER string, AUTHORIZATIONID string")


PROCESS = parse_rules({"R": {"logic": {"and": [{"op": "=", "attr": "PERMIT_ID", "value": "1"}]}}})


def test_holds_are_ordered_by_text_and_attached_by_first_key(spark):
    records = event_sets.event_set_with_holds(
        permit_table(spark), hold_table(spark), event_sets.Ruleset(PROCESS, HOLD_RULES), SPEC)
    got = {r["record_id"]: r for r in lines(records)}
    assert set(got) == {1, 2, 5}
    codes = [e["coding"]["code"] for e in got[1]["on_hold_event_set"]]
    assert codes == ["C_ONE", "C_TWO", "C_ONE"]  # id "10" comes before "2"; the hold without a start is gone
    assert got[1]["on_hold_event_set"][0]["event"] == {
        "start_datetime": "2020-01-01T00:00:00Z", "end_datetime": "2020-01-01T00:00:00Z"}
    assert got[1]["on_hold_event_set"][0]["coding"]["code_display"] == "C One"
    assert len(got[2]["on_hold_event_set"]) == 1
    assert got[5]["process_event_set"] == [] and len(got[5]["on_hold_event_set"]) == 3
    assert len(got[1]["process_event_set"]) == 1


def test_one_record_for_a_heavy_key(spark):
    holds = hold_table(spark)
    many = holds.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("copy")
    rules = event_sets.Ruleset(PROCESS, HOLD_RULES)
    once = event_sets.event_set_with_holds(permit_table(spark), holds, rules, SPEC)
    whole = event_sets.event_set_with_holds(permit_table(spark), many, rules, SPEC)
    size = lambda df: {r["record_id"]: len(r["on_hold_event_set"]) for r in df.collect()}
    assert size(whole) == {k: 500 * n for k, n in size(once).items()} and whole.count() == once.count()



def test_hold_hits_count_matches_without_event(spark):
    report = event_sets.hold_hit_report(permit_table(spark), hold_table(spark), HOLD_RULES)
    assert [(r["rule"], r["hits"]) for r in report.collect()] == [("H1", 7), ("H2", 4)]


def test_hit_report_lists_rules_without_hits(spark):
    df = spark.createDataFrame([("1",), ("2",)], "A string")
    rules = [Rule(f"R{i}", {"and": [{"op": "=", "attr": "A", "value": v}]}) for i, v in enumerate("x1y")]
    got = hit_report(rule_hits(df, rules), rules, top=2).collect()
    assert [(r["rule"], r["hits"]) for r in got] == [("R1", 1), ("R0", 0)]


def test_run_job_end_to_end(spark, tmp_path):
    permit_table(spark).write.parquet(str(tmp_path / "permits"))
    hold_table(spark).write.parquet(str(tmp_path / "holds"))
    files = {
        "rules": {"R": {"start_attr": "NOWHERE", "logic": {"and": [{"op": "not_null", "attr": "AUTHORIZATIONID"}]}}},
        "lifecycle": {"R": ["A", "B"]},
        "hold_rules": {"H1": {"code": "C_ONE", "start_attr": "ON_HOLD_START_DATE", "logic": ALWAYS}},
        "codes": {"C_ONE": {"code_display": "Number one"}},
        "nothing": {"R": {"logic": {"or": []}}},
    }
    for name, content in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content), encoding="utf-8")
    output = jsonl.output_path(str(tmp_path / "out"), "water_events", "DEV", dt.date(2024, 5, 6))
    assert output.endswith("/out/dev/water_events_dev_20240506.jsonl")
    job = event_sets.JobFiles(
        permits=str(tmp_path / "permits"), rules=str(tmp_path / "rules.json"), output=output,
        lifecycle=str(tmp_path / "lifecycle.json"), holds=str(tmp_path / "holds"),
        hold_rules=str(tmp_path / "hold_rules.json"), hold_code_map=str(tmp_path / "codes.json"))
    result = event_sets.run_job(spark, job, SPEC)
    assert (result.lines, result.missing_permit_columns, result.missing_hold_columns) == (4, ["NOWHERE", "system_id"], [])
    assert result.source_rows == permit_table(spark).count() and dict(result.process_hits)["R"] >= result.process_events > 0
    assert dict(result.hold_hits)["H1"] >= result.on_hold_events > 0
    named = event_sets.run_named_job(spark, "water tracking, holds", replace(job, output=str(tmp_path / "named")), SPEC, "DEV", dt.date(2024, 5, 6))
    assert named == result
    again = jsonl.read_lines(spark, str(tmp_path / "named/dev/water_tracking_holds_dev_20240506.jsonl"))
    assert {json.loads(r["value"])["system_id"] for r in again.collect()} == {"ITSM-6117"}
    records = [json.loads(r["value"]) for r in jsonl.read_lines(spark, output).collect()]
    assert len(records) == 4
    first = next(r for r in records if r["record_id"] == 1)
    assert first["process_event_set"][0]["process"]["code_set"] == ["A", "B"]
    assert first["process_event_set"][0]["event"] == {}
    assert first["on_hold_event_set"][0]["coding"]["code_display"] == "Number one"
    assert event_sets.run_job(spark, job, SPEC, max_rows=1).lines <= 1
    empty = replace(job, rules=str(tmp_path / "nothing.json"), holds=None, hold_rules=None)
    assert event_sets.run_job(spark, empty, SPEC).lines == 0
    with pytest.raises(EmptyOutput):
        event_sets.run_job(spark, empty, SPEC, fail_on_empty=True)


def test_lines_of_a_job_are_stored_compressed(spark, tmp_path):
    """Lines are several times the size of the rows they are made from, and most of it repeats."""
    spark.range(3_000).selectExpr("id AS PERMIT_ID", "current_date() AS RECEIVED").write.parquet(str(tmp_path / "permits"))
    (tmp_path / "rules.json").write_text(json.dumps({"R": {"start_attr": "RECEIVED", "logic": ALWAYS}}), encoding="utf-8")
    job = event_sets.JobFiles(permits=str(tmp_path / "permits"), rules=str(tmp_path / "rules.json"), output=str(tmp_path / "packed"))
    plain = replace(job, output=str(tmp_path / "plain"), compression="none")
    assert event_sets.run_job(spark, job, SPEC).lines == event_sets.run_job(spark, plain, SPEC).lines == 3_000
    size = {f.output: sum(p.stat().st_size for p in Path(f.output).glob("part-*")) for f in (job, plain)}
    assert size[job.output] * 3 < size[plain.output]
    numbered = jsonl.read_numbered_lines(spark, job.output).collect()
    assert sorted(r["line_no"] for r in numbered) == list(range(1, 3_001))
    ids = [{json.loads(r["value"])["record_id"] for r in lines} for lines in (numbered, jsonl.read_lines(spark, plain.output).collect())]
    assert ids[0] == ids[1] == set(range(3_000))


def test_jobs_and_default_system_ids():
    assert {j.default_system_id for j in event_sets.JOBS.values()} == {"ITSM-5314", "ITSM-6197", "ITSM-6117", "ITSM-6072"}
    assert sum(j.with_holds for j in event_sets.JOBS.values()) == 5


def test_rules_are_worked_out_once(spark):
    """The plan must not repeat the rules in a filter below the projections."""
    df = permit_table(spark)
    plan = event_sets.event_set(df, PROCESS, SPEC)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan
