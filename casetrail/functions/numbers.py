"""Number parsing that yields NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import is_number
from .text import attribute_text, number_text, strip, without_exponent

# Wide enough for any amount; join keys use ``number_key``, which has no bound.
KEY_NUMBER = T.DecimalType(38, 10)
_NUMERAL = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\z"
# Below this a double holds every whole number, so dropping the fraction through it is exact.
_EXACT_WHOLE = 9007199254740992.0


def to_number(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Number or NULL; thousands commas in text are ignored."""
    if is_number(dtype):
        return c.try_cast(KEY_NUMBER)
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast(KEY_NUMBER)
    text = F.regexp_replace(strip(c), ",", "")
    return F.when(text.rlike(_NUMERAL), text.try_cast(KEY_NUMBER))


def to_bigint(c: Column) -> Column:
    """Whole number from text of digits; ``12.0`` is not one."""
    return F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast("bigint")


def number_key(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Text that equal numbers share, however long: no exponent, no zeros that don't count. NULL if it is no number."""
    if is_number(dtype):
        digits = number_text(c, dtype)
        return F.when(digits.rlike(_NUMERAL), digits)
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("string")
    plain = without_exponent(F.regexp_replace(strip(c), ",", ""))
    parts = r"^([+-]?)0*(\d*?)(?:\.(\d*?)0*)?\z"
    whole, part = F.regexp_extract(plain, parts, 2), F.regexp_extract(plain, parts, 3)
    number = F.concat(
        F.when(whole == "", F.lit("0")).otherwise(whole), F.when(part == "", F.lit("")).otherwise(F.concat(F.lit("."), part))
    )
    signed = F.when(F.startswith(plain, F.lit("-")) & (number != "0"), F.concat(F.lit("-"), number)).otherwise(number)
    return F.when(plain.rlike(_NUMERAL), signed)


def truncated(c: Column, target: str) -> Column:
    """Lossy landing conversion: fraction dropped towards zero, out of range is NULL."""
    return c.try_cast(target)


def whole_number_text(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Digits of the number in ``c`` cut at the decimal point, NULL if it is no number.

    Exact at any length: identifiers beyond the whole-number range of a double keep every digit.
    """
    if isinstance(dtype, T.IntegralType):
        return c.cast("string")
    text = strip(attribute_text(c, dtype))
    as_double = F.when(text.rlike(_NUMERAL), text.try_cast("double"))
    small = F.when(F.abs(as_double) < _EXACT_WHOLE, as_double.try_cast("bigint").cast("string"))
    signed = F.regexp_extract(text, r"^([+-]?\d+)(?:\.\d*)?\z", 1)
    plain = F.regexp_replace(signed, r"^\+?(-?)0*(\d)", "$1$2")
    large = F.when(as_double.isNotNull(), F.nullif(plain, F.lit("")))
    exponent = F.nullif(F.regexp_extract(without_exponent(as_double.cast("string")), r"^(-?\d+)", 1), F.lit(""))
    return F.coalesce(small, large, exponent)
