"""Rewritten patterns against Python's own matcher."""

import re

import pytest
from pyspark.sql import functions as F

from casetrail.operators.patterns import PatternError, rewritten
from casetrail.operators.rules import RuleError, parse_rules
from casetrail.plans.event_sets import process_hit_report

TEXTS = ["", "Montréal", "Montreal", "ᐃᓄᒃᑎᑐᑦ", "Tŝilhqot'in", "xʷməθkʷəy̓əm", "A-12", "a_1", "٣٤", "12", "½ x²", "a b", "a b\n", "a b\n\n", "x\r\ny",
         "line two", "tab\there", "aa bb aa", "ÉCOLE école", "ſ K k", "ß", "a+b[c]", "\\d", "日本 12", "foo.bar", "é\n12\né", "  ", "​x", "$1", "𝒜 1", "abab"]
PATTERNS = [r"^\w+$", r"\W", r"\bcole\b", r"(?i)école", r"\d+", r"\D\d", r"^\s*$", r"\S\s\S", r".", r"^.*$", r"a.b", r"(?s)a.+b", r"(?m)^\d+$", r"b$", r"b\Z", r"\Ax",
            r"(?P<first>\w)(?P=first)", r"(?P<a>x)", r"(a|b)\1", r"(?a)^\w+$", r"(?a)\bM", r"(?x) a  b # words", r"[^\w\s]", r"[\W_]", r"[^\W\d]+", r"[a-z]{2,3}?", r"(?:ab){2}",
            r"(?<=n)t", r"(?<!n)t", r"(?=.*\d)\w", r"\Bn\B", r"\B", r"[éÉ]", r"(?i)[é-ë]", r"(?i)k", r"\.", r"[\]\[]", r"\\d", r"[$]1", r"x*+", r"(?>a+)b", r"(?i:É)cole", r"[^a]", r"a{2}",
            r"é", r"\x41", r"a|", r"", r"[\d-]", r"(?i)ß", r"𝒜", r"[^\n]{5}", r"(?P<q>['a])b"]


def test_same_texts_are_found(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    row = df.orderBy("i").select(*[F.col("t").rlike(rewritten(p)).alias(f"p{k}") for k, p in enumerate(PATTERNS)]).collect()
    for k, pattern in enumerate(PATTERNS):
        assert [r[k] for r in row] == [re.search(pattern, t) is not None for t in TEXTS], pattern


def test_every_letter_digit_and_space(spark):
    """Python's classes by character; a few numbers that it doesn't count as such are no letters for either."""
    kinds = {r"\w": [], r"\d": [], r"\s": []}
    codes = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in codes], "c int, t string")
    for r in df.select("c", *[F.col("t").rlike(rewritten(p)).alias(p[1]) for p in kinds]).collect():
        for p in kinds:
            if r[p[1]] != (re.search(p, chr(r["c"])) is not None):
                kinds[p].append(r["c"])
    # The two know different editions of the character tables; letters of living scripts are the same in both.
    assert not kinds[r"\s"] and all(len(v) < 0.1 * len(codes) for v in kinds.values())
    assert not [c for v in kinds.values() for c in v if c < 0x0870]


@pytest.mark.parametrize("pattern", [r"(a)?(?(1)b|c)", "(", "[a", r"(?P<x>a)(?P<x>b)", "*a", r"(?<=a+)b"])
def test_refused_with_the_rules_name(spark, pattern):
    rules = parse_rules({"odd one": {"logic": {"and": [{"attr": "a", "op": "regex", "value": pattern}]}, "start_attr": "a"}})
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(RuleError, match="rule 'odd one': bad pattern"):
        process_hit_report(df, rules)
    with pytest.raises(PatternError):
        rewritten(pattern)


def test_a_rule_with_a_named_group_runs(spark):
    rules = parse_rules({"twice": {"logic": {"and": [{"attr": "a", "op": "regex", "value": r"^(?P<x>\w)(?P=x)\Z"}]}, "start_attr": "a"}})
    df = spark.createDataFrame([("éé",), ("éè",), ("aa",), ("aa\n",)], "a string")
    assert process_hit_report(df, rules).first()["hits"] == 2


def test_characters_of_two_units_stand_before_a_place(spark):
    texts = ["", "𝒜", "𝒜x", "𝒜 x", "x𝒜", "😀x", "😀 x", "𝒜𝒜x", "😀😀", "a😀x", "ax", " x", "x", "𝒜😀x", "😀𝒜x", "\n𝒜", "𝒜\nx"]
    patterns = [r"\b", r"\B", r"\bx", r"\Bx", r"𝒜\b", r"𝒜\B", r"(?<=\w)x", r"(?<=\W)x", r"(?<!\w)x", r"(?<!\W)x", r"(?<=𝒜)x", r"(?<!𝒜)x", r"(?<=[^a])x", r"(?<=\w\w)x",
                r"(?<=\W\w)x", r"(?<=.{2})x", r"(?<!.{2})x", r"(?<=a.)x", r"(?<=)x", r"(?<!)x", r"(?<=^𝒜)x", r"(?m)(?<=^)x", r"(?<=(?:𝒜|😀)\b)x", r"(?a)\bx", r"(?<=\b)x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.orderBy("i").select(*[F.col("t").rlike(rewritten(p)).alias(f"p{k}") for k, p in enumerate(patterns)]).collect()
    for k, pattern in enumerate(patterns):
        assert [r[k] for r in rows] == [re.search(pattern, t) is not None for t in texts], pattern
