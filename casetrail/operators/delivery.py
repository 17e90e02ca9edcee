"""Outcome of sending records to a service, worked out from a log of attempts.

The log has one row per attempt: ``record_id``, ``line_no``, ``attempt`` (from 1), ``status``
(NULL if the call raised) and ``error``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_text import is_json, on_one_line
from ..functions.text import strip

# Which answers are worth another attempt, and the limits of trying.
RETRY_STATUSES = (408, 429, 500, 502, 503, 504)
AUTH_STATUSES = (401, 403)
MAX_ATTEMPTS = 3
BACKOFF_CAP_SECONDS = 10

DELIVERED, FAILED, PENDING = "delivered", "failed", "pending"


def backoff_seconds(attempt: Column, cap: int = BACKOFF_CAP_SECONDS) -> Column:
    """Wait after an attempt: doubling from one second, capped."""
    return F.least(F.pow(F.lit(2), attempt - 1).cast("bigint"), F.lit(cap).cast("bigint"))


def outcomes(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS, with_auth: bool = True,
             with_answer: bool = True) -> DataFrame:
    """One row per record: delivered, failed or pending, with the attempt that decided.

    ``with_answer`` puts the answer's text behind the status in ``error``, as jobs with holds do; the others give the
    status alone.

    Rows are first reduced to one per record and attempt, and attempts past the limit are left
    out: trying stops there. So the list gathered per record has at most ``max_attempts`` entries
    however long the log is.
    """
    once = (
        attempts.filter((F.col("attempt") >= 1) & (F.col("attempt") <= max_attempts))
        .groupBy("record_id", "line_no", "attempt")
        .agg(F.min(F.struct("status", "error")).alias("answer"))
        .select("record_id", "line_no", "attempt", "answer.status", "answer.error")
    )
    log = F.array_sort(F.collect_list(F.struct("attempt", "status", "error")))
    per_record = once.groupBy("record_id", "line_no").agg(log.alias("log"))

    auth_tries = F.filter("log", lambda a: a["status"].isin(*AUTH_STATUSES) & (a["attempt"] < max_attempts))
    refreshed_at = F.get(auth_tries, 0)["attempt"] if with_auth else F.lit(None).cast("int")

    def is_final(a: Column) -> Column:
        open_end = a["attempt"] < max_attempts
        try_again = a["status"].isNull() | a["status"].isin(*RETRY_STATUSES)
        refresh = F.coalesce(a["attempt"] == refreshed_at, F.lit(False))
        return ~(open_end & (F.coalesce(try_again, F.lit(False)) | refresh))

    decided = per_record.withColumn("final", F.get(F.filter("log", is_final), 0))
    status = F.col("final.status")
    outcome = (
        F.when(F.col("final").isNull(), PENDING)
        .when((status >= 200) & (status < 300), DELIVERED)
        .otherwise(FAILED)
    )
    return decided.select(
        "record_id", "line_no", outcome.alias("outcome"),
        F.coalesce("final.attempt", F.size("log")).alias("attempts"),
        status.alias("status_code"),
        F.when(
            outcome == FAILED,
            F.when(status.isNull(), F.col("final.error")).otherwise(
                F.concat(F.lit("HTTP "), status.cast("string"),
                         F.concat(F.lit(": "), F.coalesce("final.error", F.lit(""))) if with_answer else F.lit(""))
            ),
        ).alias("error"),
    )


def totals(decided: DataFrame) -> DataFrame:
    """Records delivered, failed and pending."""
    return decided.agg(*[
        F.count_if(F.col("outcome") == kind).alias(kind) for kind in (DELIVERED, FAILED, PENDING)
    ])


def sendable_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines worth sending: not blank, and JSON as senders read it, with NaN, Infinity and repeated keys allowed.

    The lines stay as they are, whatever the length of their numbers, their nesting or their size.
    """
    content = strip(F.col(column))
    return lines.filter((content != "") & is_json(content))


def error_bucket(decided: DataFrame, records: DataFrame) -> DataFrame:
    """Failed records with line number, status, reason and the record itself.

    ``records`` has ``record_id``, ``line_no`` and the JSON text ``value``.
    """
    failed = decided.filter(F.col("outcome") == FAILED).drop("outcome", "attempts")
    return failed.join(records, ["record_id", "line_no"]).select(
        "line_no", "record_id", "status_code", "error", F.col("value").alias("record")
    )


def error_lines(bucket: DataFrame) -> DataFrame:
    """Error bucket as JSON lines, the record nested as the text it was sent as; null where it is no JSON."""
    record = strip(F.col("record"))
    fields = F.to_json(F.struct("line_no", "record_id", "status_code", "error"), {"ignoreNullFields": "false"})
    nested = F.when(is_json(record), on_one_line(record)).otherwise(F.lit("null"))
    return bucket.select(F.concat(F.left(fields, F.length(fields) - 1), F.lit(',"record":'), nested, F.lit("}")).alias("value"))
