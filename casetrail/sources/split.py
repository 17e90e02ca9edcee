"""Predicates that cut a table into pieces of about equal size, so that many tasks can read it from a database.

Every row, also one without a key, meets exactly one predicate of a list.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import column_of, is_number

# A number from 0 to {pieces} - 1 for each key, as the database systems write it.
KEY_NUMBERS = {
    "oracle": "ORA_HASH({key}, {pieces} - 1)",
    "sqlserver": "ABS(CAST(CHECKSUM({key}) AS BIGINT)) % {pieces}",
    "postgresql": "ABS(CAST(HASHTEXT(CAST({key} AS TEXT)) AS BIGINT)) % {pieces}",
    "spark": "PMOD(XXHASH64({key}), {pieces})",
}
# Bounds lie this many times closer to the true quantiles than a piece is wide.
_FINER = 100


class Unsplittable(ValueError):
    """A key that ranges cannot be made of."""


def key_bounds(keys: DataFrame, column: str, pieces: int) -> list[Any]:
    """Keys at which the pieces but the first begin, in order: quantiles of the keys given, which may be a sample.

    The keys are folded into sketches where they lie; only the bounds come to the driver. A key with more rows than a
    piece should have takes a piece for itself, so there may be fewer bounds than ``pieces`` - 1.
    """
    if pieces < 1:
        raise ValueError("there must be a piece")
    key, kind = column_of(keys, column)
    if not (is_number(kind) or isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))):
        raise Unsplittable(f"'{column}' is {kind.simpleString()}: its order in the database may be another; cut by key numbers")
    if pieces == 1:
        return []
    usable = ~F.isnan(key) if isinstance(kind, (T.DoubleType, T.FloatType)) else key.isNotNull()
    at = [i / pieces for i in range(1, pieces)]
    found = keys.filter(usable).agg(F.percentile_approx(key, at, _FINER * pieces).alias("bounds"), F.min(key).alias("least")).first()
    bounds = sorted(set(found["bounds"] or ()))
    # Nothing lies in front of the smallest key.
    return [b for b in bounds if b != found["least"]]


def range_predicates(column: str, bounds: Sequence[Any]) -> list[str]:
    """One predicate for each range between bounds; rows without a key are in the first."""
    if not bounds:
        return ["1 = 1"]
    marks = [_literal(b) for b in bounds]
    first = f"({column} < {marks[0]} OR {column} IS NULL)"
    inner = [f"({column} >= {low} AND {column} < {high})" for low, high in zip(marks, marks[1:], strict=False)]
    return [first, *inner, f"({column} >= {marks[-1]})"]


def number_predicates(column: str, pieces: int, system: str) -> list[str]:
    """One predicate for each key number; for keys that are text, or whose values say nothing about their number."""
    if system not in KEY_NUMBERS:
        raise ValueError(f"no key number is known for '{system}', only for {', '.join(KEY_NUMBERS)}")
    number = KEY_NUMBERS[system].format(key=column, pieces=pieces)
    return [
        f"({column} IS NULL OR {number} = 0)" if i == 0 else f"({column} IS NOT NULL AND {number} = {i})" for i in range(pieces)
    ]


def split_report(rows: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """What the predicates make of a table, in one pass: ``pieces``, ``rows``, ``rows_taken_once``, and ``fewest`` and
    ``most`` rows of a piece."""
    met = [F.coalesce(F.expr(p), F.lit(False)) for p in predicates]
    taken = F.lit(0)
    for m in met:
        taken = taken + m.cast("int")
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(taken == 1).alias("rows_taken_once"), F.array(*[F.count_if(m) for m in met]).alias("sizes")
    )
    return counts.select(
        F.lit(len(predicates)).cast("bigint").alias("pieces"), "rows", "rows_taken_once",
        F.array_min("sizes").alias("fewest"), F.array_max("sizes").alias("most"),
    )


def _literal(value: Any) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    return format(value, "f") if isinstance(value, Decimal) else repr(value)
