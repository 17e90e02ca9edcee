"""Looking columns up by name without regard to case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """Column name safe to pass to ``F.col`` even if it holds dots, blanks or quotes."""
    return "`" + name.replace("`", "``") + "`"


def find_field(schema: T.StructType, name: str) -> T.StructField | None:
    wanted = name.lower()
    return next((f for f in schema.fields if f.name.lower() == wanted), None)


def column_of(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """Column and type; a column the table lacks reads as a NULL string."""
    field = find_field(df.schema, name)
    if field is None:
        return F.lit(None).cast("string"), T.StringType()
    return F.col(quoted(field.name)), field.dataType


def is_instant(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType))


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))
