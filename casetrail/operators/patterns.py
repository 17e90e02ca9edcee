"""Patterns written for Python's matcher, rewritten for the one that Spark runs.

Python reads the pattern; its parts are then written down so that the other matcher finds the same: letters, digits,
white space and word ends of all scripts, line ends that are a newline alone, groups by number. What has no
counterpart is refused.
"""

from __future__ import annotations

import re
from re import _constants as part
from re import _parser
from typing import Any


class PatternError(ValueError):
    """A pattern that is broken, or has something that the other matcher lacks."""


# What the classes have, as the inside of a character class; letter case never matters for them.
_UNICODE = {"WORD": r"\p{L}\p{N}_", "DIGIT": r"\p{Nd}", "SPACE": r"\t-\r\x{1c}- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"}
_ASCII = {"WORD": "a-zA-Z0-9_", "DIGIT": "0-9", "SPACE": r"\t-\r "}
_LAST_END = r"(?=\n?\z)"
#: The second half of a character of two units.
_SECOND_UNIT = r"[\x{dc00}-\x{dfff}]"


def rewritten(pattern: str) -> str:
    """The pattern for Spark's ``rlike``."""
    try:
        re.compile(pattern)
        parsed = _parser.parse(pattern)
    except (re.error, OverflowError, RecursionError) as problem:
        raise PatternError(str(problem)) from problem
    return _sequence(parsed, parsed.state.flags)


def _sequence(parts: Any, flags: int) -> str:
    return "".join(_written(kind, value, flags) for kind, value in parts)


def _literal(code: int) -> str:
    one = chr(code)
    return one if one.isascii() and (one.isalnum() or one in " _") else f"\\x{{{code:x}}}"


def _fold(text: str, flags: int) -> str:
    """Marks a part whose letters match in either case."""
    if not flags & re.IGNORECASE:
        return text
    return f"(?{'i' if flags & re.ASCII else 'iu'}:{text})"


def _classes(flags: int) -> dict[str, str]:
    return _ASCII if flags & re.ASCII else _UNICODE


def _set(items: list[tuple[Any, Any]], flags: int) -> str:
    """A character class. Its classes that are the opposite of another stand beside it."""
    negated = bool(items) and items[0][0] is part.NEGATE
    inside, beside = "", []
    for kind, value in items[negated:]:
        if kind is part.LITERAL:
            inside += _literal(value)
        elif kind is part.RANGE:
            inside += f"{_literal(value[0])}-{_literal(value[1])}"
        elif kind is part.CATEGORY:
            opposite, _, name = str(value).removeprefix("CATEGORY_").rpartition("NOT_")
            chars = _classes(flags)[name]
            if opposite or str(value).startswith("CATEGORY_NOT_"):
                beside.append(f"[^{chars}]")
            else:
                inside += chars
        else:
            raise PatternError(f"a character class with {kind}")
    either = "|".join([_fold(f"[{inside}]", flags)] * bool(inside) + beside)
    return f"(?:(?!{either})(?s:.))" if negated else f"(?:{either})"


def _behind(inner: str, width: int, negated: bool = False) -> str:
    """Whether ``inner``, of ``width`` characters, stands before. The other matcher goes back by as many units as it takes
    characters to be, and a character may have two; so an alternative that is never met makes room for them, and no
    start is inside a character."""
    return rf"(?<{'!' if negated else '='}(?!{_SECOND_UNIT})(?:{inner})|(?!)(?s:.){{{2 * width}}})"


def _place(kind: Any, flags: int) -> str:
    word = f"[{_classes(flags)['WORD']}]"
    at_edge = rf"(?:{_behind(word, 1)}(?!{word})|{_behind(word, 1, negated=True)}(?={word}))"
    if kind is part.AT_BEGINNING:
        return r"(?:\A|(?<=\n))" if flags & re.MULTILINE else r"\A"
    if kind is part.AT_END:
        return r"(?=\n|\z)" if flags & re.MULTILINE else _LAST_END
    if kind is part.AT_BEGINNING_STRING:
        return r"\A"
    if kind is part.AT_END_STRING:
        return r"\z"
    if kind is part.AT_BOUNDARY:
        return at_edge
    if kind is part.AT_NON_BOUNDARY:
        # There is no such place in an empty text, nor inside a character of two units.
        return rf"(?!\A\z|{_SECOND_UNIT}|{at_edge})"
    raise PatternError(f"the place {kind}")


_REPEATS = {part.MAX_REPEAT: "", part.MIN_REPEAT: "?", part.POSSESSIVE_REPEAT: "+"}


def _written(kind: Any, value: Any, flags: int) -> str:
    if kind is part.LITERAL:
        return _fold(_literal(value), flags)
    if kind is part.NOT_LITERAL:
        return _set([(part.NEGATE, None), (part.LITERAL, value)], flags)
    if kind is part.ANY:
        return "(?s:.)" if flags & re.DOTALL else r"[^\n]"
    if kind is part.IN:
        return _set(value, flags)
    if kind is part.AT:
        return _place(value, flags)
    if kind is part.BRANCH:
        return "(?:" + "|".join(_sequence(branch, flags) for branch in value[1]) + ")"
    if kind is part.SUBPATTERN:
        group, added, removed, inner = value
        return f"({'' if group else '?:'}{_sequence(inner, (flags | added) & ~removed)})"
    if kind in _REPEATS:
        least, most, inner = value
        upper = "" if most is part.MAXREPEAT else most
        return f"(?:{_sequence(inner, flags)}){{{least},{upper}}}{_REPEATS[kind]}"
    if kind is part.ATOMIC_GROUP:
        return f"(?>{_sequence(value, flags)})"
    if kind in (part.ASSERT, part.ASSERT_NOT):
        direction, inner = value
        if direction < 0:
            return _behind(_sequence(inner, flags), inner.getwidth()[1], negated=kind is part.ASSERT_NOT)
        return f"(?{'=' if kind is part.ASSERT else '!'}{_sequence(inner, flags)})"
    if kind is part.GROUPREF:
        return _fold(f"(?:\\{value})", flags)
    if kind is part.FAILURE:
        return "(?!)"
    raise PatternError(f"{kind} has no counterpart")
