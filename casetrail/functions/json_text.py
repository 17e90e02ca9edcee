"""JSON judged as text: nothing is read into numbers or objects, so no value is too long, too deep or too large."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Control characters that no JSON text has; four of them stand for tokens below.
_STRAY = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
_VALUE, _TEXT, _MEMBER, _OPEN_TEXT = "\x01", "\x02", "\x03", "\x04"

# Quantifiers keep what they took, and a text is taken up to where it breaks off if it isn't closed: one pass, however
# long a token is.
_TEXTS = r'"(?:[^"\\\x00-\x1F]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+("?+)'
_SCALARS = r"-?(?:(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+|Infinity)|true|false|null|NaN"

# What may be made of tokens, in this order: a member of a key and its value, one of several members or values side by
# side in their brackets, a value of brackets that hold one kind at most.
_STEPS = (
    (_TEXT + ":" + _VALUE, _MEMBER),
    (rf"(?<=[\[,]){_VALUE}(?:,{_VALUE})++", _VALUE),
    (rf"(?<=[{{,]){_MEMBER}(?:,{_MEMBER})++", _MEMBER),
    (rf"\[{_VALUE}?\]|\{{{_MEMBER}?\}}", _VALUE),
)
# Deep texts: brackets of a kind with one value inside. The first run of many is taken off whole, wherever as many stand; its
# pattern begins where a run does, so that no run is read from each of its brackets. What is left goes a few at once.
_MANY, _FEW = 64, 8
_DEEP = tuple(
    (begin, end, rf"(?<!{pattern})((?:{pattern}){{{_MANY},}}+){_VALUE}({closing}{{{_MANY},}}+)",
     [(f"(?:{pattern}){{{_FEW}}}{_VALUE}{closing}{{{_FEW}}}", _VALUE)])
    for begin, end, pattern, closing in (("[", "]", r"\[", r"\]"), ("{" + _TEXT + ":", "}", rf"\{{{_TEXT}:", r"\}"))
)
# Levels between two looks at whether anything still changes.
_AT_ONCE = 32


def is_json(text: Column) -> Column:
    """Whether a text is JSON as most readers take it: NaN, Infinity and repeated keys are let through. Never NULL.

    Texts and scalars become one character each; then the innermost brackets become values, one level at a time, until
    one value is left or nothing changes. A level costs one pass over what the levels inside it have left.
    """
    tokens = F.regexp_replace(text, _TEXTS, _OPEN_TEXT + "$1")
    tokens = F.replace(tokens, F.lit(_OPEN_TEXT + '"'), F.lit(_TEXT))
    tokens = F.regexp_replace(tokens, _SCALARS, _VALUE)
    tokens = F.regexp_replace(tokens, r"[ \t\n\r]++", "")
    tokens = F.regexp_replace(tokens, _TEXT + "(?!:)", _VALUE)
    # As an element of an array, the tokens are worked out once for both uses.
    left = F.get(F.transform(F.array(tokens), _reduced), 0)
    return F.coalesce(~text.rlike(_STRAY) & (left == _VALUE), F.lit(False))


def _reduced(tokens: Column) -> Column:
    """The tokens after as many levels as they can have; no work is done once nothing changes."""
    opened = F.length(F.regexp_replace(tokens, r"[^\[{]++", ""))

    def level(state: Column, _: Column) -> Column:
        # Each branch works on the state itself, so that nothing is worked out twice.
        now = state["now"]
        for begin, end, run, steps in _DEEP:
            fewer = _replaced(_without_run(state["now"], begin, end, run), steps)
            now = F.when(F.contains(state["now"], F.lit(begin * _FEW)), fewer).otherwise(now)
        now = _replaced(now, _STEPS)
        return F.when(state["now"] == state["before"], state).otherwise(F.struct(now.alias("now"), state["now"].alias("before")))

    def levels(state: Column, _: Column) -> Column:
        some = F.aggregate(F.sequence(F.lit(1), F.lit(_AT_ONCE)), state, level)
        return F.when(state["now"] == state["before"], state).otherwise(some)

    start = F.struct(tokens.alias("now"), F.lit("").alias("before"))
    return F.aggregate(F.sequence(F.lit(0), F.floor(opened / _AT_ONCE)), start, levels, lambda state: state["now"])


def _without_run(text: Column, begin: str, end: str, run: str) -> Column:
    opening, closing = F.length(F.regexp_extract(text, run, 1)) / len(begin), F.length(F.regexp_extract(text, run, 2))
    many = F.least(opening, closing).cast("int")
    return F.replace(text, F.concat(F.repeat(F.lit(begin), many), F.lit(_VALUE), F.repeat(F.lit(end), many)), F.lit(_VALUE))


def _replaced(text: Column, steps: Iterable[tuple[str, str]]) -> Column:
    for pattern, made in steps:
        text = F.regexp_replace(text, pattern, made)
    return text


def on_one_line(text: Column) -> Column:
    """The same JSON without line breaks, which stand between tokens alone."""
    return F.regexp_replace(text, r"[\r\n]+", " ")
