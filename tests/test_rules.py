"""Compiled rules against the row model, and errors at compile time."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from casetrail.operators.facets import Facets
from casetrail.operators.rules import (
    Rule, RuleError, match_column, missing_columns, parse_hold_rules, parse_rules, required_columns,
)

from .rule_model import rule_holds

SCHEMA = """id int, T1 string, T2 string, N1 int, N2 double, N3 decimal(20,4), B1 boolean,
            S1 timestamp_ntz, S2 timestamp_ntz, D1 date, D2 date"""
TEXTS = [
    None, "", " ", "null", "NaT", "nan", "abc", "b", "Zebra", "2020-01-01", "2020-01-01 05:00:00", "2020-01-01T05:00:00Z",
    "2020-01-01T05:00:00-08:00", "2020-01-01T13:00:00+00:00", "2020-13-45", "10:30", "2020", "5", "é",
    "2020-01-01 05:00:00.25", "2021-06-30x",
]
STAMPS = [None, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 5), dt.datetime(2021, 6, 30, 1, 2, 3, 400)]
DAYS = [None, dt.date(2020, 1, 1), dt.date(2021, 6, 30)]
COLUMNS = ["T1", "T2", "N1", "N2", "N3", "B1", "S1", "S2", "D1", "D2", "absent"]
LITERALS = [
    "abc", "b", "2020-01-01", "5", " ", "null", None, 5, 0, 1, -2.5, 2.25, True, ["abc", 5, "2020-01-01"],
    [1, 2.25, None], [], "abcdef 2020", "",
]
PATTERNS = ["^2020", "05:00:00", "[0-9]+$", "a", "True", "\\.0$", "00$", "\\+00:00$"]


def sample_rows(rng, n=120):
    return [
        (i, rng.choice(TEXTS), rng.choice(TEXTS), rng.choice([None, 0, 1, 5, -3]),
         rng.choice([None, 0.0, 1.0, 2.25, -2.5, float("nan")]), rng.choice([None, Decimal("5.0000"), Decimal("2.2500")]),
         rng.choice([None, True, False]), rng.choice(STAMPS), rng.choice(STAMPS), rng.choice(DAYS), rng.choice(DAYS))
        for i in range(n)
    ]


def random_test(rng):
    op = rng.choice(["null", "not_null", "=", "!=", ">", ">=", "<", "<=", "in", "regex", "=", "<"])
    test = {"op": op, "attr": rng.choice(COLUMNS)}
    if op == "regex":
        if rng.random() < 0.7:
            test["value"] = rng.choice(PATTERNS)
        elif rng.random() < 0.5:
            test["other_attr"] = rng.choice(COLUMNS)
        else:
            test["value"] = 5
    elif op not in ("null", "not_null"):
        if rng.random() < 0.4:
            test["other_attr"] = rng.choice(COLUMNS)
        else:
            test["value"] = rng.choice(LITERALS)
    return test


def random_tree(rng, depth=2):
    word = rng.choice(["and", "or"])
    parts = [
        random_tree(rng, depth - 1) if depth and rng.random() < 0.3 else random_test(rng)
        for _ in range(rng.randint(0, 3))
    ]
    return {word: parts}


def same_as_model(spark, trees, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    facets = Facets(df.schema)
    found = [match_column(Rule(f"r{i}", tree), facets).alias(f"r{i}") for i, tree in enumerate(trees)]
    names = [f.name for f in df.schema.fields]
    by_id = {r[0]: dict(zip(names, r, strict=True)) for r in rows}
    for got in facets.project(df).select("id", *found).collect():
        row = by_id[got["id"]]
        for i, tree in enumerate(trees):
            assert got[f"r{i}"] == rule_holds(tree, row), (tree, row)


@pytest.mark.parametrize("seed", range(4))
def test_single_tests_match_model(spark, seed):
    rng = random.Random(seed)
    same_as_model(spark, [{"and": [random_test(rng)]} for _ in range(60)], sample_rows(rng))


@pytest.mark.parametrize("seed", range(3))
def test_trees_match_model(spark, seed):
    rng = random.Random(100 + seed)
    same_as_model(spark, [random_tree(rng) for _ in range(40)], sample_rows(rng))


@pytest.mark.parametrize("logic", [
    {}, {"and": [{"op": "="}]}, {"and": [{"attr": "A"}]}, {"and": [{"op": "like", "attr": "A", "value": "x"}]},
    {"or": [{"op": "regex", "attr": "A", "value": "("}]},
])
def test_bad_rules_are_named(spark, logic):
    df = spark.createDataFrame([("x",)], "A string")
    with pytest.raises(RuleError, match="BAD_RULE"):
        match_column(Rule("BAD_RULE", logic), Facets(df.schema))


def test_source_filter_and_time_attributes():
    logic = {"and": []}
    raw = {
        "A": {"source": "SysA", "logic": logic, "start_date": {"attr": "S"}, "end_attr": "E"},
        "B": {"source": "sysb", "logic": logic},
        "C": {"logic": logic, "code_set": ["X"], "class_path": "Y"},
    }
    kept = parse_rules(raw, "SYSA")
    assert [r.key for r in kept] == ["A", "C"]
    assert (kept[0].start, kept[0].end, kept[1].code_set) == ("S", "E", ["X"])


def test_hold_rules_need_a_code():
    with pytest.raises(RuleError, match="no code"):
        parse_hold_rules({"H": {"code": " ", "logic": {"and": []}}})
    with pytest.raises(RuleError):
        parse_hold_rules([])


def test_required_and_missing_columns(spark):
    rules = [Rule("A", {"and": [{"op": "=", "attr": "X", "other_attr": "Y"}, {"or": [{"op": "null", "attr": "x"}]}]}, "S")]
    assert required_columns(rules, ["ID"]) == ["ID", "S", "X", "Y"]
    df = spark.createDataFrame([(1, 2)], "id int, x int")
    assert missing_columns(df, rules, ["ID"]) == ["S", "Y"]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("OK",), ("CA",)], "`CODE != 'CA'.x` string")
    facets = Facets(df.schema)
    hit = match_column(Rule("r", {"and": [{"op": "=", "attr": "code != 'ca'.X", "value": "OK"}]}), facets)
    assert facets.project(df).filter(hit).count() == 1
