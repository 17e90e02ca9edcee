"""Derived columns that several rules share.

Three hundred rules may test the same text attribute. What each test needs from it (is it
empty, is it a date, which instant) is projected once per row under a helper name; the rules
then read plain columns and whole-stage code generation keeps them cheap.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, text
from ..schemas import find_field, is_floating, is_instant, is_number, quoted

_PREFIX = "__facet"


# Layers of helper columns: each may read the ones before it.
_TRIMMED, _PARSED, _TIMES = range(3)


@dataclass
class Facets:
    """Collects helper columns for one schema."""

    schema: T.StructType
    layers: tuple[dict[str, Column], ...] = field(default_factory=lambda: ({}, {}, {}))
    attributes: dict[str, Attribute] = field(default_factory=dict)
    handles: dict[str, Column] = field(default_factory=dict)
    compiled: dict[str, Any] = field(default_factory=dict)

    def attribute(self, name: str) -> Attribute:
        if name.lower() not in self.attributes:
            found = find_field(self.schema, name)
            if found is None:
                made = Attribute(self, name, F.lit(None).cast("string"), T.NullType())
            else:
                made = Attribute(self, found.name, F.col(quoted(found.name)), found.dataType)
            self.attributes[name.lower()] = made
        return self.attributes[name.lower()]

    def once(self, key: str, make: Callable[[], Any]) -> Any:
        """Result of ``make``, kept: rule sets repeat the same tests many times."""
        if key not in self.compiled:
            self.compiled[key] = make()
        return self.compiled[key]

    def share(self, name: str, make: Callable[[], Column], layer: int = _TIMES) -> Column:
        """The helper column of that name, made on first use."""
        name = f"{_PREFIX}:{name}"
        if name not in self.layers[layer]:
            self.layers[layer][name] = make()
            self.handles[name] = F.col(quoted(name))
        return self.handles[name]

    def project(self, df: DataFrame) -> DataFrame:
        """The table with all helper columns asked for so far."""
        for layer in self.layers:
            df = df.withColumns(layer) if layer else df
        return df


@dataclass(frozen=True)
class Attribute:
    """One column as the rules see it."""

    facets: Facets
    name: str
    value: Column
    dtype: T.DataType

    @property
    def kind(self) -> str:
        if isinstance(self.dtype, T.NullType):
            return "missing"
        if isinstance(self.dtype, T.StringType):
            return "text"
        if isinstance(self.dtype, T.BooleanType) or is_number(self.dtype):
            return "number"
        if is_instant(self.dtype):
            return "instant"
        return "day" if isinstance(self.dtype, T.DateType) else "other"

    def _share(self, facet: str, make: Callable[[], Column], layer: int = _PARSED) -> Column:
        return self.facets.share(f"{facet}:{self.name}", make, layer)

    @property
    def trimmed(self) -> Column:
        return self._share("trimmed", lambda: text.strip(text.attribute_text(self.value, self.dtype)), _TRIMMED)

    @property
    def nullish(self) -> Column:
        if self.kind == "text":
            trimmed = self.trimmed
            return self._share("nullish", lambda: text.trimmed_is_nullish(trimmed))
        return self.value.isNull()

    @property
    def instant(self) -> Column:
        """Instant of a date-like text or a timestamp; NULL for text that is no date."""
        if self.kind == "text":
            return self._share("instant", lambda: dates.iso_instant(self._without_z()))
        return self.value.cast("timestamp")

    @property
    def zoned(self) -> Column:
        if self.kind == "text":
            return self._share("zoned", lambda: dates.has_offset(self._without_z()))
        return F.lit(False)

    def _without_z(self) -> Column:
        return F.replace(self.value, F.lit("Z"), F.lit(""))

    @property
    def numeric(self) -> Column:
        return self.value.cast("int") if isinstance(self.dtype, T.BooleanType) else self.value

    @property
    def unordered(self) -> Column:
        """NaN equals nothing and has no order."""
        return F.isnan(self.value) if is_floating(self.dtype) else F.lit(False)

    @property
    def printed(self) -> Column:
        """Text a pattern is searched in: date-like text appears as date and time."""
        if self.kind != "text":
            return text.attribute_text(self.value, self.dtype)

        def render() -> Column:
            stamp = text.attribute_text(self.instant_of_wall_clock(), T.TimestampNTZType())
            return F.when(
                dates.iso_instant(self._without_z()).isNotNull(),
                F.concat(stamp, self._offset_text()),
            ).otherwise(self.value)

        return self._share("printed", render)

    def instant_of_wall_clock(self) -> Column:
        """The clock reading as written, its offset set aside."""
        clock = F.regexp_replace(self._without_z(), r"(?<=[T ].{2,30})[+-]\d{2}(?::?\d{2})?\z", "")
        return clock.try_cast("timestamp_ntz")

    def _offset_text(self) -> Column:
        tail = F.regexp_extract(self._without_z(), r"[T ].*?([+-]\d{2})(?::?(\d{2}))?\z", 1)
        minutes = F.regexp_extract(self._without_z(), r"[T ].*?[+-]\d{2}:?(\d{2})\z", 1)
        return F.when(tail == "", F.lit("")).otherwise(
            F.concat(tail, F.lit(":"), F.when(minutes == "", F.lit("00")).otherwise(minutes))
        )

    @property
    def event_datetime(self) -> Column:
        if self.kind == "missing":
            return self.value
        if self.kind in ("instant", "day"):
            return self._share("datetime", lambda: dates.event_datetime(self.value, self.dtype))
        trimmed = self.trimmed
        return self._share("datetime", lambda: dates.datetime_of_text(trimmed))

    @property
    def event_date(self) -> Column:
        if self.kind in ("missing", "instant", "day"):
            return F.substring(self.event_datetime, 1, 10)
        trimmed = self.trimmed
        return self._share("date", lambda: dates.date_of_text(trimmed))
