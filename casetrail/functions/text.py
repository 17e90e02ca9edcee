"""Blank tests, text conversion and join-key cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import is_floating, is_number

# The characters a whitespace trim removes, and the words read as "no value".
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
NULL_WORDS = ("null", "nat")
LINE_BREAK_TAG = "<br>"


def strip(c: Column) -> Column:
    """Trim every kind of whitespace (Spark's own ``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """NULL, or text that is empty once trimmed. Never NULL itself."""
    if not isinstance(dtype, T.StringType):
        return c.isNull()
    return F.coalesce(strip(c), F.lit("")) == ""


def is_nullish(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Blank, or one of the words that stand for a missing value in any letter case."""
    return trimmed_is_nullish(strip(c)) if isinstance(dtype, T.StringType) else c.isNull()


def trimmed_is_nullish(trimmed: Column) -> Column:
    return F.coalesce(F.lower(trimmed), F.lit("")).isin("", *NULL_WORDS)


def blank_to_null(c: Column) -> Column:
    """Text trimmed of plain blanks, empty text as NULL (the SQL sources' rule)."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def without_exponent(digits: Column) -> Column:
    """The text of a number with its point moved to where the exponent says; other text as it is. No digit is lost."""
    pattern = r"^([+-]?)(\d+)\.?(\d*)[eE]([+-]?\d{1,4})\z"
    sign, whole, part = (F.regexp_extract(digits, pattern, k) for k in (1, 2, 3))
    shift = F.regexp_extract(digits, pattern, 4).try_cast("int") + F.length(whole)
    both = F.concat(whole, part)
    left = F.when(shift > 0, F.rpad(F.left(both, shift), shift, F.lit("0"))).otherwise(F.lit("0"))
    right = F.when(shift > 0, F.substring(both, shift + 1, F.length(both))).otherwise(F.concat(F.repeat(F.lit("0"), -shift), both))
    moved = F.concat(sign, left, F.when(right != "", F.concat(F.lit("."), right)).otherwise(F.lit("")))
    return F.when(digits.rlike(pattern), moved).otherwise(digits)


def number_text(c: Column, dtype: T.DataType) -> Column:
    """Digits of a number: no exponent, no zeros after the last decimal that counts."""
    if isinstance(dtype, T.IntegralType):
        return c.cast("string")
    digits = without_exponent(c.cast("string"))
    shortened = F.regexp_replace(digits, r"^(-?\d+)(?:\.0*|(\.\d*[1-9])0*)$", "$1$2")
    return F.coalesce(shortened, c.cast("string"))


def plain_text(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Text of any value the way the staging flows print it."""
    if isinstance(dtype, T.StringType):
        return c
    return number_text(c, dtype) if is_number(dtype) else c.cast("string")


def attribute_text(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Text of any value the way the rules see it: True/False, 12.0 for a whole double,
    six fraction digits on an instant that has any."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if is_floating(dtype):
        digits = number_text(c, dtype)
        return F.when(digits.rlike(r"^-?\d+$"), F.concat(digits, F.lit(".0"))).otherwise(digits)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        micros = F.date_format(c, "SSSSSS")
        return F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))
    return c.cast("string")


def text_or_null(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Text of a value, NULL where it is nullish."""
    return F.when(~is_nullish(c, dtype), attribute_text(c, dtype))


def key_text(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Join key: trimmed text, blank as NULL."""
    return F.nullif(strip(plain_text(c, dtype)), F.lit(""))


def _clean_key(text: Column, zero_tail: str) -> Column:
    """Trimmed text; only text with a comma or a dot is worked on further."""
    trimmed = strip(text)
    digits = F.regexp_replace(F.replace(trimmed, F.lit(","), F.lit("")), zero_tail, "$1")
    cleaned = F.when(trimmed.contains(",") | trimmed.contains("."), strip(digits)).otherwise(trimmed)
    return F.nullif(cleaned, F.lit(""))


def staged_key(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Key of the staging joins: commas out, and the text before the first dot
    where the digits up to the next dot are all zeros (``1.0.5`` gives ``1``)."""
    if is_number(dtype):
        return number_text(c, dtype)
    return _clean_key(plain_text(c, dtype), r"(?s)^([^.]*)\.0*(?:\..*)?\z")


def hold_key(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Key of the on-hold join: nullish is NULL, commas out, an all-zero tail out
    (``1.0.5`` stays)."""
    if isinstance(dtype, T.IntegralType) or is_floating(dtype):
        return number_text(c, dtype)
    return F.when(~is_nullish(c, dtype), _clean_key(c.cast("string"), r"(?s)^([^.]*)\.0*\z"))


def without_line_breaks(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit(LINE_BREAK_TAG), F.lit(""))


def first_present(columns: list[Column]) -> Column:
    """First identifier that is not blank, trimmed."""
    return F.coalesce(*[blank_to_null(c) for c in columns])


def status_guard(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """The status itself, ``OK`` where there is none."""
    return F.when(is_blank(c, dtype), F.lit("OK")).otherwise(plain_text(c, dtype))


def display_name(code: str) -> str:
    """Display form of a code. Codes are literals of the rule set, so this runs once per rule."""
    return code.replace("_", " ").title()


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
