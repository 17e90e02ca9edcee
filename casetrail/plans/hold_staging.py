"""On-hold periods without duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.dedup import keep_first

# The business key of a hold and the columns that are staged.
HOLD_KEY = ("ATHN_ON_HOLD_REASON_CODE", "AUTHORIZATION_ID", "ON_HOLD_START_DATE", "ON_HOLD_END_DATE")
HOLD_ID = "AUTHORIZATION_ON_HOLD_ID"
HOLD_COLUMNS = (
    "AUTHORIZATION_ON_HOLD_ID",
    "ATHN_ON_HOLD_REASON_CODE",
    "AUTHORIZATION_ID",
    "CURRENT_ON_HOLD_IND",
    "WHO_CREATED",
    "WHEN_CREATED",
    "ON_HOLD_START_DATE",
    "ON_HOLD_END_DATE",
    "ON_HOLD_NOTES",
    "REMOVED_BY",
    "WHO_UPDATED",
    "WHEN_UPDATED",
    "PARTNER_AGENCY_ID",
)


def staged_holds(holds: DataFrame, all_columns: bool = False) -> DataFrame:
    """Lowest id per reason, authorization, start and end; missing parts of the key are equal."""
    source = holds if all_columns else holds.select(*HOLD_COLUMNS)
    return keep_first(source, HOLD_KEY, [HOLD_ID])
