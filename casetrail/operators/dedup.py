"""Keeping one row per key, and milestone roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import quoted

_RANK = "__rank"


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given order. NULL keys form one group.

    Spark ranks within each map task before the shuffle and passes on one row per key and
    task, so a key that holds a third of all rows costs no more than any other.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(first)).filter(F.col(_RANK) == 1).drop(_RANK)


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key. All columns take part in the order, so the choice is always the same."""
    sortable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    rest = [F.col(quoted(c)) for c in sortable if c not in keys]
    return keep_first(df, [F.col(quoted(k)) for k in keys], rest or [F.lit(0)])


def latest_milestones(tasks: DataFrame, key: str, milestones: Sequence[str]) -> DataFrame:
    """Latest date of each milestone per key, combined before the shuffle."""
    return tasks.groupBy(F.col(quoted(key))).agg(*[F.max(quoted(m)).alias(m) for m in milestones])


def newest_first(c: Column) -> Column:
    return c.desc_nulls_last()
