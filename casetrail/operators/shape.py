"""Column names, layouts and types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, numbers, text
from ..schemas import column_of, find_field, is_instant, is_number, quoted


class MissingColumn(ValueError):
    """A table lacks a column under all of its known names."""


def upper_names(df: DataFrame) -> DataFrame:
    """Column names trimmed and in upper case."""
    return df.toDF(*[c.strip().upper() for c in df.columns])


def canonical(df: DataFrame, name: str, aliases: Sequence[str], table: str) -> DataFrame:
    """Adds ``name`` from the first alias the table has; the alias column stays."""
    if name in df.columns:
        return df
    found = next((a for a in aliases if a in df.columns), None)
    if found is None:
        raise MissingColumn(
            f"no column of {table} can serve as {name}; it has {', '.join(df.columns)}"
        )
    return df.withColumn(name, F.col(quoted(found)))


def first_useful(df: DataFrame, names: Sequence[str]) -> Column:
    """First of the columns that holds more than blanks or a bare clock time.

    Columns the table lacks are passed over. Columns of one type keep it; mixed types become text.
    """
    fields = [f for f in (find_field(df.schema, n) for n in names) if f is not None]
    if not fields:
        return F.lit(None).cast("string")
    values = [dates.useful_value(F.col(quoted(f.name)), f.dataType) for f in fields]
    if len({f.dataType.simpleString() for f in fields}) > 1:
        values = [text.plain_text(v, f.dataType) for v, f in zip(values, fields, strict=True)]
    return F.coalesce(*values)


def ensure_columns(df: DataFrame, sources: Mapping[str, Sequence[str]]) -> DataFrame:
    """Adds each column the table lacks, from the first useful of its sources.

    A column that exists is left alone even if it is empty. Later columns may draw on earlier ones.
    """
    for name, names in sources.items():
        if find_field(df.schema, name) is None:
            df = df.withColumn(name, first_useful(df, names))
    return df


def typed_nulls(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """Adds NULL columns of the given types, so that tables share one layout."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in layout.items()})


def fixed_layout(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is an analysis error."""
    return df.select(*[F.col(quoted(c)).alias(c) for c in columns])


def converted(c: Column, dtype: T.DataType, target: str) -> Column:
    """Typed conversion that gives NULL instead of an error."""
    if target == "string":
        return text.plain_text(c, dtype)
    if target.startswith("timestamp"):
        stamp = c if is_instant(dtype) else dates.read_instant(text.plain_text(c, dtype))
        return stamp.try_cast(target)
    if target == "bigint":
        return F.round(numbers.to_number(c, dtype)).try_cast("bigint")
    return c.try_cast(target)


def convert_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Converts the named columns; all others pass through."""
    wanted = {name.lower(): target for name, target in types.items()}
    return df.select(*[
        converted(F.col(quoted(f.name)), f.dataType, wanted[f.name.lower()]).alias(f.name)
        if f.name.lower() in wanted else F.col(quoted(f.name))
        for f in df.schema.fields
    ])


def keep_usable_key(df: DataFrame, name: str) -> DataFrame:
    """Rows whose key is neither NULL nor blank."""
    value, dtype = column_of(df, name)
    return df.filter(~text.is_blank(value, dtype))


def allow_list(df: DataFrame, columns: Sequence[str], clean_dates: Sequence[str] = ()) -> DataFrame:
    """Redacting projection: only these columns leave, placeholder dates as NULL."""
    cleaned = {c.lower() for c in clean_dates}
    out = []
    for name in columns:
        found = find_field(df.schema, name)
        value = F.col(quoted(found.name if found else name))
        out.append((dates.clean_sentinel(value, found.dataType) if name.lower() in cleaned else value).alias(name))
    return df.select(*out)


def land(df: DataFrame, mapping: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Column-mapped landing: (source, target, type) per column, all else is dropped.

    Conversions may lose data but never fail: a fraction going to a whole type is cut,
    a value that does not fit becomes NULL.
    """
    out = []
    for source, target, kind in mapping:
        value, dtype = column_of(df, source)
        out.append(_landed(value, dtype, kind).alias(target))
    return df.select(*out)


def _landed(value: Column, dtype: T.DataType, kind: str) -> Column:
    whole = kind in ("int", "integer", "bigint", "long")
    if whole and is_number(dtype) and not isinstance(dtype, T.IntegralType):
        return numbers.truncated(value, kind)
    if kind == "string":
        return value.cast("string")
    return value.try_cast(kind)
