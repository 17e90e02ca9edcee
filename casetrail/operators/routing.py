"""Sending a row to one of several identifiers, splitting and appending tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_KIND = "id_kind"


def route(df: DataFrame, choices: Sequence[tuple[str, Column, Column]], id_column: str) -> DataFrame:
    """Gives each row the id of the first choice that is not blank.

    A choice is (name, blank test, id text). Rows without any id are left out.
    """
    chosen = kind = None
    for name, blank, value in choices:
        if chosen is None:
            chosen, kind = F.when(~blank, value), F.when(~blank, F.lit(name))
        else:
            chosen, kind = chosen.when(~blank, value), kind.when(~blank, F.lit(name))
    routed = df.withColumns({id_column: chosen, ID_KIND: kind})
    return routed.filter(F.col(ID_KIND).isNotNull())


def split(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, and all the others (also those where the test is NULL)."""
    passes = F.coalesce(test, F.lit(False))
    return df.filter(passes), df.filter(~passes)


def append(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both tables, columns matched by name, NULL where one lacks a column."""
    return first.unionByName(second, allowMissingColumns=True)
