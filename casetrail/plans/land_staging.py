"""Wide staged land rows, one per disposition transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import staged_key
from ..operators.dedup import keep_any
from ..operators.joins import lookup
from ..schemas import column_of

# Columns brought in from applications and authorizations, and the prefixes
# of those whose names are taken.
APPLICATION_COLUMNS = tuple(
    """JOBID TRACKINGNUMBER BUSINESSAREANUMBER_CORAL ATSLINKID LANDSFILENUMBER SUBMITTER APPLICANT
    AUTHORIZATIONTYPE APPLICATIONTYPE CREATEDDATE STATUS OFFICE BUSINESSAREA SUBMITTEDDATE
    RECEIVEDDATE DATECOMPLETED ATSAUTHORIZATIONNUMBER ATS_LANDSFILENUMBER BUSINESSAREANUMBER""".split()
)
AUTHORIZATION_COLUMNS = tuple(
    """APPLICATION_ACCEPTED_DATE APPLICATION_RECEIVED_DATE APPLICATION_REJECTED_DATE
    APPLICATION_FEE AUTHORIZATION_DUE_DATE AUTHORIZATION_FEE ADJUDICATION_DATE
    FCBC_PROCESS_COMPLETE_DATE AUTHORIZATION_STATUS_CODE ATHN_CLOSE_REASON_CODE
    FIRST_NATION_START_DATE FIRST_NATION_COMPLETION_DATE FILE_NUMBER WHEN_CREATED
    WHEN_UPDATED""".split()
)
APPLICATION_PREFIX, AUTHORIZATION_PREFIX = "VFCBC_", "ATS_"
LAND_SYSTEM_ID = "ITSM-6072"


def one_per_key(df: DataFrame, key_column: str, columns: Sequence[str], key: str,
                wanted: DataFrame | None = None) -> DataFrame:
    """Columns to bring in, one row per cleaned key; rows without a key are dropped.

    ``wanted`` has the keys that will be looked up: only their rows are sorted out.
    """
    keyed = df.select(staged_key(*column_of(df, key_column)).alias(key), *columns).filter(F.col(key).isNotNull())
    if wanted is not None:
        keyed = keyed.join(wanted.select(key).distinct(), key, "left_semi")
    return keep_any(keyed, [key])


def land_staging(dispositions: DataFrame, applications: DataFrame, authorizations: DataFrame,
                 id_column: str, system_id: str = LAND_SYSTEM_ID) -> DataFrame:
    """Dispositions with one application and one authorization each; no row fans out."""
    key, auth_key = "__area_key", "__auth_key"
    rows = dispositions.withColumn(
        key, staged_key(*column_of(dispositions, "DISPOSITION_TRANSACTION_SID"))
    ).filter(F.col(key).isNotNull())
    rows = lookup(rows, one_per_key(applications, "BUSINESSAREANUMBER", APPLICATION_COLUMNS, key, rows),
                  [(key, key)], columns=APPLICATION_COLUMNS, prefix=APPLICATION_PREFIX, complete=True)
    rows = rows.withColumn(auth_key, staged_key(*column_of(rows, "ATSAUTHORIZATIONNUMBER")))
    rows = lookup(rows, one_per_key(authorizations, "AUTHORIZATION_ID", AUTHORIZATION_COLUMNS, auth_key),
                  [(auth_key, auth_key)], columns=AUTHORIZATION_COLUMNS, prefix=AUTHORIZATION_PREFIX)
    return rows.withColumns({"system_id": F.lit(system_id), id_column: F.col(key)}).drop(key, auth_key)
