"""Scalar functions over whole columns."""

from pyspark.sql import functions as F

from casetrail.functions import dates, ids, numbers, text
from casetrail.operators.shape import first_useful
from casetrail.schemas import column_of

from . import shapes
from .registry import query, with_shapes

KEYS = """
SELECT o_orderkey AS id,
       CASE o_orderkey % 12
            WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' NULL ' WHEN 3 THEN 'NaT'
            WHEN 4 THEN CAST(o_orderkey AS STRING) || '.0'
            WHEN 5 THEN ' 1,' || CAST(o_orderkey AS STRING) || '.000'
            WHEN 6 THEN CAST(o_orderkey AS STRING) || '.50'
            WHEN 7 THEN CAST(o_orderkey AS STRING) || '.0.5'
            WHEN 8 THEN '00' || CAST(o_orderkey AS STRING)
            WHEN 9 THEN CAST(o_orderkey AS STRING) || 'e2'
            WHEN 10 THEN '-' || CAST(o_orderkey AS STRING) || '.75'
            ELSE ' AB' || CAST(o_orderkey AS STRING) || ' ' END AS raw,
       CAST(o_orderkey AS DOUBLE) AS as_double,
       o_totalprice AS price,
       CAST(o_orderkey AS DECIMAL(38,18)) AS as_decimal
FROM {orders}"""


@query(with_shapes(
    r"""SELECT id,
        raw IS NULL OR lower(trim(raw)) IN ('', 'null', 'nat') AS nullish,
        raw IS NULL OR trim(raw) = '' AS blank,
        nullif(trim(raw), '') AS key,
        nullif(regexp_replace(replace(trim(raw), ',', ''), '^([^.]*)\.0*(\..*)?$', '\1'), '') AS staged,
        CASE WHEN lower(trim(raw)) NOT IN ('', 'null', 'nat')
             THEN regexp_replace(replace(trim(raw), ',', ''), '^([^.]*)\.0*$', '\1') END AS hold,
        CAST(id AS VARCHAR) AS key_of_double,
        CAST(id AS VARCHAR) AS key_of_decimal,
        CASE WHEN lower(trim(raw)) NOT IN ('', 'null', 'nat') THEN raw END AS text_value
    FROM keys""", keys=KEYS))
def key_cleaning(t):
    keys = t.shape(KEYS)
    raw = F.col("raw")
    return keys.select(
        "id",
        text.is_nullish(raw).alias("nullish"),
        text.is_blank(raw).alias("blank"),
        text.key_text(raw).alias("key"),
        text.staged_key(raw).alias("staged"),
        text.hold_key(raw).alias("hold"),
        text.staged_key(*column_of(keys, "as_double")).alias("key_of_double"),
        text.hold_key(*column_of(keys, "as_decimal")).alias("key_of_decimal"),
        text.text_or_null(raw).alias("text_value"),
    )


@query(with_shapes(
    r"""SELECT id,
        CAST(CASE WHEN regexp_full_match(replace(trim(raw), ',', ''), '[+-]?[0-9]+(\.[0-9]*)?(e[0-9]+)?')
                  THEN TRY_CAST(replace(trim(raw), ',', '') AS DECIMAL(38,10)) END AS VARCHAR) AS number,
        CASE WHEN regexp_full_match(trim(raw), '-?[0-9]+') THEN TRY_CAST(trim(raw) AS BIGINT) END AS whole,
        CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+(\.[0-9]*)?(e[0-9]+)?')
             THEN CAST(CAST(trunc(CAST(trim(raw) AS DOUBLE)) AS BIGINT) AS VARCHAR) END AS record_id,
        regexp_replace(CAST(price AS VARCHAR), '\.0$', '') AS price_text,
        CAST(trunc(price) AS INTEGER) AS price_cut
    FROM keys""", keys=KEYS))
def number_parsing(t):
    keys = t.shape(KEYS)
    raw = F.col("raw")
    return keys.select(
        "id",
        numbers.to_number(raw).cast("string").alias("number"),
        numbers.to_bigint(raw).alias("whole"),
        numbers.whole_number_text(raw).alias("record_id"),
        text.number_text(*column_of(keys, "price")).alias("price_text"),
        numbers.truncated(F.col("price"), "int").alias("price_cut"),
    )


@query(with_shapes(
    """SELECT JOBID,
        coalesce(nullif(trim(CAST(JOBID AS VARCHAR)), ''), nullif(trim(TRACKINGNUMBER), ''),
                 CAST(ATSLINKID AS VARCHAR)) AS first_id,
        replace(STATUSSHOWNTOCLIENT, '<br>', '') AS shown,
        CASE WHEN trim(TRACKINGNUMBER) = '' THEN 'OK' ELSE TRACKINGNUMBER END AS guarded
    FROM applications""", applications=shapes.APPLICATIONS))
def status_text(t):
    return t.shape(shapes.APPLICATIONS).select(
        "JOBID",
        text.first_present([F.col("JOBID"), F.col("TRACKINGNUMBER"), F.col("ATSLINKID")]).alias("first_id"),
        text.without_line_breaks(F.col("STATUSSHOWNTOCLIENT")).alias("shown"),
        text.status_guard(F.col("TRACKINGNUMBER")).alias("guarded"),
    )


# Some event times moved onto the placeholder day and before the calendar's start.
OLD_DATES = """
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN ts - INTERVAL 45290 DAY - (ts - date_trunc('day', ts))
                         WHEN 1 THEN ts - INTERVAL 45290 DAY
                         WHEN 2 THEN ts - INTERVAL 170000 DAY ELSE ts END AS stamp,
       CASE event_id % 5 WHEN 0 THEN '10:30' WHEN 1 THEN '10:30, 5' WHEN 2 THEN ' '
                         WHEN 3 THEN CAST(ts AS STRING) ELSE '2024-01-02' END AS noted,
       ts
FROM {events}"""


@query(with_shapes(
    """SELECT event_id,
        CASE WHEN stamp = DATE '1900-01-01' THEN NULL WHEN stamp < DATE '1582-10-15' THEN NULL
             ELSE stamp END AS cleaned,
        date_trunc('second', ts + INTERVAL 500 MILLISECOND) AS to_second,
        noted = '10:30' AS time_only,
        CASE WHEN noted <> '10:30' THEN noted END AS without_time_only,
        coalesce(CASE WHEN noted <> '10:30' AND trim(noted) <> '' THEN noted END, CAST(event_id AS VARCHAR)) AS useful,
        CAST(stamp AS DATE) >= DATE '2014-04-01' AS since
    FROM old""", old=OLD_DATES))
def date_cleaning(t):
    old = t.shape(OLD_DATES)
    noted = F.col("noted")
    return old.select(
        "event_id",
        dates.clean_sentinel(*column_of(old, "stamp")).alias("cleaned"),
        dates.to_second(*column_of(old, "ts")).alias("to_second"),
        dates.is_time_only(noted).alias("time_only"),
        dates.without_time_only(noted).alias("without_time_only"),
        first_useful(old, ["absent", "noted", "event_id"]).alias("useful"),
        dates.on_or_after(F.col("stamp"), "2014-04-01").alias("since"),
    )


@query(with_shapes(
    r"""SELECT PERMIT_ID,
        CASE PERMIT_ID % 6 WHEN 0 THEN replace(NOTED, ' ', 'T') || 'Z'
                           WHEN 1 THEN NOTED || 'T00:00:00Z'
                           WHEN 3 THEN substr(NOTED, 1, 10) || 'T08:00:00Z'
                           WHEN 4 THEN NOTED || 'T00:00:00Z' END AS noted_datetime,
        CASE WHEN PERMIT_ID % 6 IN (0, 1, 3) THEN substr(NOTED, 1, 10) END AS noted_date,
        strftime(RECEIVED, '%Y-%m-%dT%H:%M:%SZ') AS received_datetime,
        strftime(RECEIVED, '%Y-%m-%d') AS received_date
    FROM permits""", permits=shapes.PERMITS))
def event_time_text(t):
    permits = t.shape(shapes.PERMITS)
    return permits.select(
        "PERMIT_ID",
        dates.event_datetime(F.col("NOTED")).alias("noted_datetime"),
        dates.event_date(F.col("NOTED")).alias("noted_date"),
        dates.event_datetime(*column_of(permits, "RECEIVED")).alias("received_datetime"),
        dates.event_date(*column_of(permits, "RECEIVED")).alias("received_date"),
    )


@query("""SELECT count(*) AS ids, count(*) AS well_formed, count(*) AS different FROM orders""")
def transaction_ids(t):
    """Ids differ on every run, so their number, form and uniqueness are compared."""
    made = t.table("orders").select(ids.time_ordered_uuid().alias("u"))
    form = r"^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return made.agg(
        F.count("*").alias("ids"),
        F.count_if(F.col("u").rlike(form)).alias("well_formed"),
        F.count_distinct("u").alias("different"),
    )


_Y, _M, _D = (f"CAST({part}(o_orderdate) AS STRING)" for part in ("year", "month", "day"))
_NAME = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * month(o_orderdate) - 2, 3)"
# One order's day in thirteen forms, some with a clock time, the last one no date at all.
WRITTEN_DATES = f"""
SELECT o_orderkey, o_orderdate,
       CASE o_orderkey % 13
            WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
            WHEN 1 THEN {_Y} || '/' || {_M} || '/' || {_D}
            WHEN 2 THEN {_M} || '/' || {_D} || '/' || {_Y}
            WHEN 3 THEN lpad({_M}, 2, '0') || '-' || lpad({_D}, 2, '0') || '-' || substr({_Y}, 3, 2)
            WHEN 4 THEN {_NAME} || '  ' || {_D} || ' ' || {_Y} || ' 12:00AM'
            WHEN 5 THEN lower({_NAME}) || '. ' || {_D} || ', ' || {_Y}
            WHEN 6 THEN {_D} || '-' || upper({_NAME}) || '-' || substr({_Y}, 3, 2)
            WHEN 7 THEN {_D} || ' ' || {_NAME} || ' ' || {_Y} || ' 3:04:05.600 p.m.'
            WHEN 8 THEN {_Y} || lpad({_M}, 2, '0') || lpad({_D}, 2, '0')
            WHEN 9 THEN {_M} || '.' || {_D} || '.' || {_Y} || ' 14:30'
            WHEN 10 THEN {_Y}
            WHEN 11 THEN '10:30'
            ELSE {_NAME} || ' 32 ' || {_Y} END AS written
FROM {{orders}}"""


@query(with_shapes(
    """SELECT o_orderkey, written, CASE WHEN o_orderkey % 13 < 10 THEN date_trunc('day', o_orderdate)
            + CASE o_orderkey % 13 WHEN 7 THEN INTERVAL '54246' SECOND WHEN 9 THEN INTERVAL '52200' SECOND
                   ELSE INTERVAL '0' SECOND END END AS read,
        CASE o_orderkey % 13
            WHEN 2 THEN CASE WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) END
            WHEN 8 THEN CAST(o_orderdate AS DATE) END AS day_first
    FROM written""", written=WRITTEN_DATES))
def written_dates(t):
    """Date text of several customs; where days come first, only forms of plain numbers change their meaning."""
    written = t.shape(WRITTEN_DATES)
    other = dates.read_instant(F.col("written"), day_first=True).cast("date")
    return written.select(
        "o_orderkey", "written", dates.to_second(*column_of(written, "written")).cast("timestamp_ntz").alias("read"),
        F.when((F.col("o_orderkey") % 13).isin(2, 8), other).alias("day_first"),
    )
