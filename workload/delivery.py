"""Delivery outcomes, and tables and lines written and read back."""

import uuid

from pyspark.sql import functions as F

from casetrail.operators import delivery
from casetrail.session import scratch_path
from casetrail.sources import jsonl, tables
from casetrail.sources.catalogue import replica_specs
from casetrail.sources.replicate import ReplicaSpec, landed, replica_counts, replicate

from . import shapes
from .registry import query, with_shapes

OUTCOMES_SQL = """
SELECT record_id, line_no, outcome, attempts, status_code,
    CASE WHEN outcome = 'failed' THEN CASE WHEN status_code IS NULL THEN error
         ELSE 'HTTP ' || status_code || ': ' || error END END AS error
FROM (
  SELECT record_id, line_no, any_value(error) AS error,
    arg_min(status, attempt) FILTER (final AND status IS NOT NULL AND attempt = first_final) AS status_code,
    coalesce(min(attempt) FILTER (final), count(*)) AS attempts,
    CASE WHEN count(*) FILTER (final) = 0 THEN 'pending'
         WHEN count(*) FILTER (final AND attempt = first_final AND status BETWEEN 200 AND 299) > 0 THEN 'delivered'
         ELSE 'failed' END AS outcome
  FROM (SELECT *, min(attempt) FILTER (final) OVER (PARTITION BY record_id, line_no) AS first_final FROM (
    SELECT *, NOT (attempt < 3 AND (status IS NULL OR status IN (408, 429, 500, 502, 503, 504)
                   OR coalesce(attempt = refreshed, false))) AS final
    FROM (SELECT *, min(attempt) FILTER (status IN (401, 403) AND attempt < 3)
                 OVER (PARTITION BY record_id, line_no) AS refreshed
          FROM (SELECT record_id, line_no, attempt, any_value(error) AS error,
                  CASE WHEN count(*) > count(status) THEN NULL ELSE min(status) END AS status
                FROM attempts WHERE attempt BETWEEN 1 AND 3 GROUP BY record_id, line_no, attempt))))
  GROUP BY record_id, line_no)"""


def decided(t):
    return delivery.outcomes(t.shape(shapes.ATTEMPTS))


@query(with_shapes(OUTCOMES_SQL, attempts=shapes.ATTEMPTS))
def delivery_outcomes(t):
    return decided(t).withColumn("attempts", F.col("attempts").cast("bigint"))


@query(with_shapes(
    f"""SELECT record_id, line_no, outcome, CASE WHEN status_code IS NOT NULL AND outcome = 'failed' THEN 'HTTP ' || status_code
        ELSE error END AS error FROM ({OUTCOMES_SQL})""", attempts=shapes.ATTEMPTS))
def outcomes_by_status_alone(t):
    """Jobs without holds give the status without the answer's text."""
    return delivery.outcomes(t.shape(shapes.ATTEMPTS), with_answer=False).select("record_id", "line_no", "outcome", "error")


@query(with_shapes(
    f"""SELECT count(*) FILTER (outcome = 'delivered') AS delivered, count(*) FILTER (outcome = 'failed') AS failed,
        count(*) FILTER (outcome = 'pending') AS pending FROM ({OUTCOMES_SQL})""", attempts=shapes.ATTEMPTS))
def delivery_totals(t):
    return delivery.totals(decided(t))


@query("""SELECT event_id, CAST(CASE attempt WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4 WHEN 4 THEN 8 ELSE 10 END
        AS BIGINT) AS seconds
    FROM (SELECT event_id, event_id % 6 + 1 AS attempt FROM events)""")
def retry_waits(t):
    return t.table("events").select(
        "event_id", delivery.backoff_seconds(F.col("event_id") % 6 + 1).alias("seconds")
    )


@query(with_shapes(
    f"""SELECT '{{"line_no":' || line_no || ',"record_id":"' || record_id || '","status_code":'
        || coalesce(CAST(status_code AS VARCHAR), 'null') || ',"error":"' || error
        || '","record":{{"record_id":"' || record_id || '"}}}}' AS value
    FROM ({OUTCOMES_SQL}) WHERE outcome = 'failed'""", attempts=shapes.ATTEMPTS))
def error_bucket_lines(t):
    records = t.shape(shapes.ATTEMPTS).select("record_id", "line_no").distinct()
    records = records.withColumn("value", F.to_json(F.struct("record_id")))
    return delivery.error_lines(delivery.error_bucket(decided(t), records))


MIXED_LINES = """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN '  ' ELSE 'no ' || props END AS value FROM {events}"""


@query(with_shapes("SELECT event_id, value FROM lines WHERE trim(value) LIKE '{%'", lines=MIXED_LINES))
def sendable_lines(t):
    return delivery.sendable_lines(t.shape(MIXED_LINES))


@query("""SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def replaced_table(t):
    """Written twice; the second refresh replaces the first."""
    path = scratch_path(t.spark, "suppliers")
    suppliers = t.table("supplier")
    tables.replace_files(suppliers.withColumn("s_name", F.lit("old")), path)
    tables.replace_files(suppliers, path)
    return tables.read_table(t.spark, path)


@query("""SELECT 'raw.nations' AS table_name, count(*) AS "rows" FROM nation
    UNION ALL SELECT 'raw.regions' AS table_name, count(*) AS "rows" FROM region""")
def replicated_counts(t):
    """Two tables copied under new names by specification."""
    folder = scratch_path(t.spark, "replica")
    specs = [
        ReplicaSpec("src", "NATION", "raw", "nations"),
        ReplicaSpec("src", "REGION", "raw", "regions", (("r_regionkey", "ID", "bigint"), ("R_NAME", "NAME", "string"))),
    ]
    replicate(
        t.spark, specs,
        read=lambda spark, spec: t.table(spec.source_table.lower()),
        write=lambda df, spec: tables.replace_files(df, f"{folder}/{spec.target_table}"),
    )
    return replica_counts({s.target: tables.read_table(t.spark, f"{folder}/{s.target_table}") for s in specs})


@query(with_shapes(
    """SELECT CAST(ATSLINKID AS BIGINT) AS ATSLINKID, CAST(ATSAUTHORIZATIONNUMBER AS INTEGER) AS ATSAUTHORIZATIONNUMBER,
        CAST(LANDSFILENUMBER AS INTEGER) AS LANDSFILENUMBER,
        CAST(DISPOSITION_TRANSACTION_SID AS INTEGER) AS DISPOSITION_TRANSACTION_SID, DISPOSITION_TRANSACTION_STRING
    FROM links""", links=shapes.LINKS))
def catalogue_columns(t):
    """A table landed by the mapping that the catalogue has for it."""
    spec = next(s for s in replica_specs("applications") if s.source_table == "VFCBC_ATSNUMBER_VW")
    return landed(t.shape(shapes.LINKS), spec)


@query("""SELECT o_orderkey, o_orderdate FROM orders""")
def old_calendar_reading(t):
    """Sources of shared views are read by the old calendar's rule, which leaves recent times alone."""
    return tables.read_table(t.spark, f"{t.folder}/orders.parquet", rebase=tables.REBASE_LEGACY).select("o_orderkey", "o_orderdate")


@query("""SELECT s_suppkey, upper(s_name) AS s_name FROM supplier""")
def view_published_again(t):
    """A session view is replaced by the next one of its name."""
    name, suppliers = f"suppliers_{uuid.uuid4().hex}", t.table("supplier").select("s_suppkey", "s_name")
    tables.publish_view(suppliers, name)
    return tables.drop_and_publish_view(suppliers.withColumn("s_name", F.upper("s_name")), name)


# Braces by number, as they mark tables in a shape.
_SENT = """SELECT event_id, CASE event_id % 6 WHEN 0 THEN chr(123) || '"a":1,"a":2' || chr(125)
    WHEN 1 THEN chr(123) || '"a":NaN' || chr(125) WHEN 2 THEN chr(123) || '"a":' WHEN 3 THEN ' '
    WHEN 4 THEN chr(123) || '"a":[-Infinity, "NaN"]' || chr(125) ELSE props END AS value FROM {events}"""


@query(with_shapes("SELECT event_id, value FROM sent WHERE event_id % 6 NOT IN (2, 3)", sent=_SENT))
def lines_worth_sending(t):
    """Repeated keys and NaN are sent; blanks and broken texts aren't."""
    return delivery.sendable_lines(t.shape(_SENT))


@query("""SELECT n_nationkey, n_name FROM nation""")
def view_stored_once(t):
    """The second call finds the view and leaves it as it is."""
    name, path = f"shared_{uuid.uuid4().hex}", scratch_path(t.spark, "view")
    nations = t.table("nation").select("n_nationkey", "n_name")
    tables.materialise_view(nations, name, path=path)
    return tables.materialise_view(nations.withColumn("n_name", F.lit("new")), name, path=path)


@query("""SELECT event_id, event_type, count(*) OVER () AS lines FROM events""")
def lines_written_and_read(t):
    path = scratch_path(t.spark, "lines")
    lines = t.table("events").select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
    written = jsonl.write_lines(lines, path)
    content = F.from_json("value", "event_id bigint, event_type string").alias("c")
    return jsonl.read_lines(t.spark, path).select(content).select(
        "c.event_id", "c.event_type", F.lit(written).cast("bigint").alias("lines")
    )


# Texts that a reader of numbers or objects would change or refuse: ids of 45 and 400 digits, a number of 1,100, and
# 1,100 brackets; and the same made invalid.
def _long_texts(number, digit):
    opened, closed = "repeat('[', 1100)", "repeat(']', 1100)"
    keyed = """chr(123) || '"record_id":'"""
    return f"""CASE {number} % 50
        WHEN 10 THEN {opened} || {keyed} || '"x","record_id":1' || chr(125) || {closed}
        WHEN 20 THEN {opened} || {digit} || {closed} || ']'
        WHEN 30 THEN '[' || {opened} || {digit} || ',' || {closed} || ']'
        ELSE {keyed} || CASE {number} % 5 WHEN 0 THEN repeat({digit}, 45) WHEN 1 THEN repeat({digit}, 400) || ',"b":"x,' || chr(92) || '"]"'
            WHEN 2 THEN '-' || repeat({digit}, 1100) || '.50e+07, "b": NaN' WHEN 3 THEN '0' || repeat({digit}, 45)
            ELSE repeat({digit}, 45) || '.' END || chr(125) END"""


def _sent(number):
    return f"CASE WHEN {number} % 50 IN (10, 20, 30) THEN {number} % 50 = 10 ELSE {number} % 5 < 3 END"


LONG_LINES = f"""SELECT event_id, {_long_texts("event_id", "CAST(event_id % 9 + 1 AS STRING)")} AS value FROM {{events}}"""
LONG_RECORDS = f"""SELECT DISTINCT CAST(user_id AS STRING) || '-' || event_type AS record_id, user_id AS line_no,
    {_long_texts("user_id", "CAST(user_id % 9 + 1 AS STRING)")} AS value FROM {{events}}"""


@query(with_shapes(f"""SELECT event_id, value FROM sent WHERE {_sent("event_id")}""", sent=LONG_LINES))
def long_lines_worth_sending(t):
    """Numbers of any length and any nesting are sent as they are; brackets too many and broken numbers aren't."""
    return delivery.sendable_lines(t.shape(LONG_LINES))


@query(with_shapes(
    f"""SELECT '{{"line_no":' || d.line_no || ',"record_id":"' || d.record_id || '","status_code":'
        || coalesce(CAST(status_code AS VARCHAR), 'null') || ',"error":"' || error
        || '","record":' || CASE WHEN {_sent("d.line_no")} THEN r.value ELSE 'null' END || '}}' AS value
    FROM ({OUTCOMES_SQL}) d JOIN records r ON d.record_id = r.record_id AND d.line_no = r.line_no
    WHERE outcome = 'failed'""", attempts=shapes.ATTEMPTS, records=LONG_RECORDS))
def bucket_of_long_records(t):
    """Failed records stand in the bucket digit by digit."""
    return delivery.error_lines(delivery.error_bucket(decided(t), t.shape(LONG_RECORDS)))


@query("""SELECT '{"line_no":' || n || ',"record_id":"' || event_id || '","status_code":400,"error":"HTTP 400: ' || event_type
        || '","record":{"record_id":"' || event_id || '","kind":"' || event_type || '"}}' AS value
    FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS n FROM events) WHERE event_id % 7 = 0""")
def bucket_of_numbered_lines(t):
    """Lines are written to several files, read back with their numbers, and those refused named by them."""
    path = scratch_path(t.spark, "numbered")
    events = t.table("events").repartitionByRange(8, "event_id").sortWithinPartitions("event_id")
    kind = F.struct(F.col("event_id").cast("string").alias("record_id"), F.col("event_type").alias("kind"))
    jsonl.write_lines(events.select(F.to_json(kind).alias("value")), path)
    records = jsonl.read_numbered_lines(t.spark, path).select(
        F.get_json_object("value", "$.record_id").alias("record_id"), "line_no", "value"
    )
    refused = F.col("record_id").cast("bigint") % 7 == 0
    log = records.select(
        "record_id", "line_no", F.lit(1).alias("attempt"), F.when(refused, 400).otherwise(200).alias("status"),
        F.get_json_object("value", "$.kind").alias("error"),
    )
    return delivery.error_lines(delivery.error_bucket(delivery.outcomes(log), records))
