"""Attaching on-hold periods to permits by a cleaned key.

Hold rules run on the hold rows before anything is shuffled, so only rows that yield an event
travel, and only with the event. Each permit gives one record with the whole ordered list of
its key's events: one shuffle by key serves the grouping and the join. A record is one JSON
line, so its events have to meet in one task; ``matched_hold_events`` gives the same events as
flat rows without gathering any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import attribute_text, hold_key
from ..schemas import column_of, find_field
from .events import HOLD_EVENTS, RecordSpec, event_array, hold_events
from .facets import Facets
from .joins import spread_missing
from .rules import Rule, match_column

# Columns that may hold the authorization a permit belongs to, in order of trust,
# and the columns of a hold row.
PERMIT_KEY_COLUMNS = (
    "ATSAUTHORIZATIONNUMBER",
    "AUTHORIZATION_ID",
    "AUTHORIZATIONID",
    "ATS_AUTHORIZATION_ID",
    "AUTHORIZATION_ID__ATS",
    "ATS_AUTHORIZATION_ID__ATS",
)
HOLD_KEY_COLUMN = "AUTHORIZATION_ID"
HOLD_REASON_COLUMN = "ATHN_ON_HOLD_REASON_CODE"
HOLD_START_COLUMN = "ON_HOLD_START_DATE"
HOLD_ID_COLUMN = "AUTHORIZATION_ON_HOLD_ID"

_KEY = "__hold_key"


def permit_key(df: DataFrame, candidates: Sequence[str] = PERMIT_KEY_COLUMNS) -> Column:
    """First candidate column with a usable key; columns the table lacks are passed over."""
    keys = [hold_key(*column_of(df, name)) for name in candidates if find_field(df.schema, name)]
    return F.coalesce(*keys) if keys else F.lit(None).cast("string")


def keyed_holds(holds: DataFrame) -> DataFrame:
    """Hold rows with a usable key, their reason code cleaned the way keys are."""
    reason, reason_type = column_of(holds, HOLD_REASON_COLUMN)
    cleaned = F.coalesce(hold_key(reason, reason_type), attribute_text(reason, reason_type))
    return (
        holds.withColumns({
            _KEY: hold_key(*column_of(holds, HOLD_KEY_COLUMN)),
            HOLD_REASON_COLUMN: cleaned,
        })
        .filter(F.col(_KEY).isNotNull())
    )


def hold_event_rows(holds: DataFrame, rules: Sequence[Rule], spec: RecordSpec) -> DataFrame:
    """One row per hold event: key, sort texts, position within its hold row, the event."""
    keyed = keyed_holds(holds)
    facets = Facets(keyed.schema)
    events = event_array(hold_events(rules, facets, spec), HOLD_EVENTS)
    return facets.project(keyed).select(
        _KEY,
        F.coalesce(attribute_text(*column_of(keyed, HOLD_START_COLUMN)), F.lit("")).alias("started"),
        F.coalesce(attribute_text(*column_of(keyed, HOLD_ID_COLUMN)), F.lit("")).alias("hold_id"),
        F.posexplode(events).alias("rule_pos", "event"),
    )


def grouped_holds(event_rows: DataFrame) -> DataFrame:
    """All events of a key, ordered by start text and then id text."""
    ordered = F.array_sort(F.collect_list(F.struct("started", "hold_id", "rule_pos", "event")))
    return event_rows.groupBy(_KEY).agg(F.transform(ordered, lambda row: row["event"]).alias("on_hold_event_set"))


def grouped_hold_hits(holds: DataFrame, rules: Sequence[Rule], spec: RecordSpec) -> DataFrame:
    """As ``grouped_holds``, with the matches of each rule per key (``hit_0`` and so on), whether they give an event or
    not. One pass over the holds."""
    keyed = keyed_holds(holds)
    facets = Facets(keyed.schema)
    events = event_array(hold_events(rules, facets, spec), HOLD_EVENTS)
    names = [f"hit_{i}" for i in range(len(rules))]
    rows = facets.project(keyed).select(
        _KEY,
        F.coalesce(attribute_text(*column_of(keyed, HOLD_START_COLUMN)), F.lit("")).alias("started"),
        F.coalesce(attribute_text(*column_of(keyed, HOLD_ID_COLUMN)), F.lit("")).alias("hold_id"),
        events.alias("events"),
        *[match_column(rule, facets).cast("bigint").alias(n) for n, rule in zip(names, rules, strict=True)],
    )
    placed = F.transform(
        "events",
        lambda e, i: F.struct(F.col("started"), F.col("hold_id"), i.alias("rule_pos"), e.alias("event")),
    )
    ordered = F.array_sort(F.flatten(F.collect_list(placed)))
    return rows.groupBy(_KEY).agg(
        F.transform(ordered, lambda row: row["event"]).alias("on_hold_event_set"), *[F.sum(n).alias(n) for n in names]
    )


def attach_holds(permits: DataFrame, grouped: DataFrame,
                 candidates: Sequence[str] = PERMIT_KEY_COLUMNS) -> DataFrame:
    """Permits with their hold events; a permit without any gets an empty array."""
    key = spread_missing(permit_key(permits, candidates))
    joined = permits.withColumn(_KEY, key).join(grouped, _KEY, "left")
    return joined.withColumn(
        "on_hold_event_set", F.coalesce("on_hold_event_set", F.array().cast(HOLD_EVENTS))
    ).drop(_KEY)


def matched_hold_events(permits: DataFrame, event_rows: DataFrame, keep: Sequence[Column],
                        candidates: Sequence[str] = PERMIT_KEY_COLUMNS) -> DataFrame:
    """One row per permit and hold event, by a plain join: nothing is gathered per key,
    so a heavy key is split by the adaptive skew join."""
    keyed = permits.select(*keep, permit_key(permits, candidates).alias(_KEY))
    return (
        keyed.filter(F.col(_KEY).isNotNull())
        .join(event_rows, _KEY)
        .select(*keyed.drop(_KEY).columns, "started", "hold_id", "rule_pos", "event.event", "event.coding")
    )


def hold_hits(permits: DataFrame, holds: DataFrame, rules: Sequence[Rule],
              candidates: Sequence[str] = PERMIT_KEY_COLUMNS) -> DataFrame:
    """Matches per on-hold rule over all permit and hold pairs, events or not.

    Both sides are counted per key first, so the join has one row per key on each side.
    """
    keyed = keyed_holds(holds)
    facets = Facets(keyed.schema)
    names = [f"hit_{i}" for i in range(len(rules))]
    hits = [F.count_if(match_column(rule, facets)).alias(n) for n, rule in zip(names, rules, strict=True)]
    per_key = facets.project(keyed).groupBy(_KEY).agg(*hits)
    owners = (
        permits.select(permit_key(permits, candidates).alias(_KEY))
        .filter(F.col(_KEY).isNotNull())
        .groupBy(_KEY)
        .agg(F.count("*").alias("owners"))
    )
    return owners.join(per_key, _KEY).agg(
        *[F.coalesce(F.sum(F.col(n) * F.col("owners")), F.lit(0)).alias(n) for n in names]
    )
