"""Land dispositions and the applications they belong to."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators.dedup import keep_first, latest_milestones, newest_first
from ..operators.joins import decode, lookup, matching, repeated, without_match
from ..operators.shape import converted, fixed_layout
from ..schemas import column_of

# Which transactions and applications count.
RECEIVED_FROM = "2014-04-01"
APPLICATION_TYPE = "NEW"
EXCLUDED_TYPE = 51
EXCLUDED_TYPE_AND_SUBTYPE = (1, 101)
LAND_BUSINESS_AREA = "Crown Land Adjudication (vFCBC)"

# Columns of the merged and of the decoded disposition view.
MILESTONES = (
    "LAND_STATUS_DAT",
    "REPORTED_DAT",
    "ADJUDICATED_DAT",
    "DISALLOWED_DAT",
    "OFFERED_DAT",
    "OFFER_NOT_ACCEPTED_DAT",
    "COMPLETED_DAT",
    "CANCELED_DAT",
)
MERGED_COLUMNS = (
    *"""APPLICATION_TYPE_CDE COMMENCEMENT_DAT COMPLEXITY_LEVEL_CDE CROWN_GRANT_YRN DISPOSITION_SID
    DISPOSITION_TRANSACTION_SID EXPIRY_DAT MANAGING_AGENCY ORG_UNIT_SID RECEIVED_DAT
    REPLMNT_FOR_DISP_TRANS_SID REVIEW_DAT SUBTYPE_SID TYPE_SID UNIT_NAME ACTIVATION_CDE FILE_CHR
    CODE_CHR_STATUS CODE_CHR_STAGE EFFECTIVE_DAT CODE_CHR_REASON TYPE_NME SUBTYPE_NME PURPOSE_NME
    SUBPURPOSE_NME DISTRICT_OFFICE""".split(),
    *MILESTONES,
)
DECODED_COLUMNS = tuple(
    """APPLICATION_TYPE_CDE STAGE_NME TYPE_NME SUBTYPE_NME PURPOSE_NME SUBPURPOSE_NME ACTIVATION_CDE
    STATUS_NME REASON_DSC DISPOSITION_SID DISPOSITION_TRANSACTION_SID REPLMNT_FOR_DISP_TRANS_SID
    FILE_CHR ORG_UNIT_SID MANAGING_AGENCY UNIT_NAME DISTRICT_OFFICE RECEIVED_DAT LAND_STATUS_DAT
    REPORTED_DAT ADJUDICATED_DAT DISALLOWED_DAT OFFERED_DAT OFFER_NOT_ACCEPTED_DAT COMMENCEMENT_DAT
    EXPIRY_DAT CANCELED_DAT EFFECTIVE_DAT REVIEW_DAT""".split()
)
DECODED_AS_INT = ("DISPOSITION_SID", "DISPOSITION_TRANSACTION_SID", "ORG_UNIT_SID")

# Columns of the layout shared by all land staging rows, in order.
SHARED_LAYOUT = tuple(
    """system_id CREATEDDATE SUBMITTEDDATE APPLICATION_RECEIVED_DATE APPLICATION_ACCEPTED_DATE
    APPLICATION_REJECTED_DATE ADJUDICATION_DATE ADJUDICATED_DAT DISALLOWED_DAT OFFERED_DAT
    OFFER_NOT_ACCEPTED_DAT COMPLETED_DAT CANCELED_DAT EXPIRY_DAT LAND_STATUS_DAT REPORTED_DAT
    FIRST_NATION_START_DATE FIRST_NATION_COMPLETION_DATE AUTHORIZATION_STATUS_CODE
    ATHN_CLOSE_REASON_CODE CODE_CHR_STATUS ATSAUTHORIZATIONNUMBER JOBID APPLICANT SUBMITTER
    AUTHORIZATIONTYPE APPLICATIONTYPE APPLICATION_TYPE_CDE STAGE_NME TYPE_NME SUBTYPE_NME
    PURPOSE_NME SUBPURPOSE_NME STATUS_V STATUS_VISIBLE_V ACTIVATION_CDE STATUS_NME REASON_DSC
    TRACKINGNUMBER ATSLINKID ATSAUTHORIZATIONNUMBER_RAW ATSPROJECTNUMBER LANDSFILENUMBER
    DISPOSITION_TRANSACTION_STRING DISPOSITION_TRANSACTION_SID_V DISPOSITION_SID
    DISPOSITION_TRANSACTION_SID REPLMNT_FOR_DISP_TRANS_SID FILE_CHR BUSINESSAREA
    BUSINESSAREANUMBER ORG_UNIT_SID MANAGING_AGENCY OFFICE UNIT_NAME DISTRICT_OFFICE CREATEDDATE_V
    SUBMITTEDDATE_V RECEIVEDDATE_V DATECOMPLETED_V RECEIVED_DAT COMMENCEMENT_DAT EFFECTIVE_DAT
    REVIEW_DAT LAND_STATUS_DAT_RAW REPORTED_DAT_RAW ADJUDICATED_DAT_RAW DISALLOWED_DAT_RAW
    OFFERED_DAT_RAW OFFER_NOT_ACCEPTED_DAT_RAW EXPIRY_DAT_RAW CANCELED_DAT_RAW CODE_CHR_STAGE
    CODE_CHR_STATUS_RAW CODE_CHR_REASON""".split()
)


def layout_type(name: str) -> str:
    """Type of a shared-layout column, told by its name."""
    if re.search(r"(DATE|_DAT)(_V|_RAW)?$|^DATECOMPLETED_V$", name):
        return "timestamp"
    return "bigint" if re.search(r"_SID(_V)?$", name) else "string"


@dataclass(frozen=True)
class DispositionTables:
    """Tables of the land disposition system."""

    transactions: DataFrame
    org_units: DataFrame
    dispositions: DataFrame
    statuses: DataFrame
    tasks: DataFrame
    types: DataFrame
    subtypes: DataFrame
    purposes: DataFrame
    subpurposes: DataFrame
    district_offices: DataFrame


@dataclass(frozen=True)
class DispositionCodes:
    """Code tables that name status, stage and reason."""

    status: DataFrame
    stages: DataFrame
    reasons: DataFrame


def counted_transactions(transactions: DataFrame) -> DataFrame:
    """New applications since the cut-off, two kinds excluded. As in SQL, a row whose type is
    unknown is left out, and so is the first type without a subtype."""
    kind, subkind = EXCLUDED_TYPE_AND_SUBTYPE
    return transactions.filter(
        dates.on_or_after(F.col("RECEIVED_DAT"), RECEIVED_FROM)
        & (F.col("APPLICATION_TYPE_CDE") == APPLICATION_TYPE)
        & (F.col("TYPE_SID") != EXCLUDED_TYPE)
        & ~((F.col("TYPE_SID") == kind) & (F.col("SUBTYPE_SID") == subkind))
    )


def current_statuses(statuses: DataFrame) -> DataFrame:
    return statuses.filter(F.col("EXPIRY_DAT").isNull())


def _joined_dispositions(t: DispositionTables) -> DataFrame:
    """Transactions with unit, disposition and current status, milestones and type names.

    Statuses and milestones are joined by the same key, one after the other, and the rows stay
    partitioned by it up to the final DISTINCT, which needs no shuffle of its own.
    """
    key = "DISPOSITION_TRANSACTION_SID"
    status = current_statuses(t.statuses).select(
        key, "CODE_CHR_STATUS", "CODE_CHR_STAGE", "CODE_CHR_REASON", "EFFECTIVE_DAT"
    )
    rows = (
        counted_transactions(t.transactions)
        .join(t.org_units.select("ORG_UNIT_SID", "UNIT_NAME"), "ORG_UNIT_SID")
        .join(t.dispositions.select("DISPOSITION_SID", "ACTIVATION_CDE", "FILE_CHR"), "DISPOSITION_SID")
        .join(status, key)
    )
    milestones = latest_milestones(t.tasks, key, MILESTONES)
    rows = lookup(rows, milestones, [(key, key)], columns=MILESTONES, complete=True)
    rows = decode(rows, t.types, [("TYPE_SID", "TYPE_SID")], {"TYPE_NME": "TYPE_NME"})
    rows = decode(rows, t.subtypes, [("TYPE_SID", "TYPE_SID"), ("SUBTYPE_SID", "SUBTYPE_SID")],
                  {"SUBTYPE_NME": "SUBTYPE_NME"})
    rows = decode(rows, t.purposes, [("PURPOSE_SID", "PURPOSE_SID")], {"PURPOSE_NME": "PURPOSE_NME"})
    rows = decode(rows, t.subpurposes, [("PURPOSE_SID", "PURPOSE_SID"), ("SUBPURPOSE_SID", "SUBPURPOSE_SID")],
                  {"SUBPURPOSE_NME": "SUBPURPOSE_NME"})
    return decode(rows, t.district_offices, [("DISTRICT_OFFICE_SID", "DISTRICT_OFFICE_SID")],
                  {"NAME": "DISTRICT_OFFICE"})


def merged_dispositions(t: DispositionTables) -> DataFrame:
    """Distinct dispositions with milestones and names, codes as they are."""
    return _joined_dispositions(t).select(*MERGED_COLUMNS).distinct()


def decoded_dispositions(t: DispositionTables, codes: DispositionCodes) -> DataFrame:
    """Distinct dispositions with status, stage and reason spelled out."""
    rows = _joined_dispositions(t)
    for table, code, name in (
        (codes.status, "CODE_CHR_STATUS", "STATUS_NME"),
        (codes.stages, "CODE_CHR_STAGE", "STAGE_NME"),
        (codes.reasons, "CODE_CHR_REASON", "REASON_DSC"),
    ):
        rows = decode(rows, table, [(code, "CODE_CHR")], {name: name})
    out = [F.col(c).cast("int").alias(c) if c in DECODED_AS_INT else F.col(c) for c in DECODED_COLUMNS]
    return rows.select(*out).distinct()


def land_applications(applications: DataFrame, business_area: str = LAND_BUSINESS_AREA) -> DataFrame:
    return applications.filter(F.col("BUSINESSAREA") == business_area)


def merged_applications(applications: DataFrame, links: DataFrame, areas: DataFrame,
                        business_area: str = LAND_BUSINESS_AREA) -> DataFrame:
    """Land applications with their authorization numbers and area numbers."""
    chosen = land_applications(applications, business_area).select(
        "JOBID", "TRACKINGNUMBER", F.col("BUSINESSAREANUMBER").alias("BUSINESSAREANUMBER_CORAL"),
        "ATSLINKID", "LANDSFILENUMBER", "SUBMITTER", "APPLICANT", "AUTHORIZATIONTYPE", "APPLICATIONTYPE",
        "CREATEDDATE", "STATUS", "OFFICE", "BUSINESSAREA", "SUBMITTEDDATE", "RECEIVEDDATE", "DATECOMPLETED",
    )
    linked = lookup(
        chosen,
        links.withColumnRenamed("LANDSFILENUMBER", "ATS_LANDSFILENUMBER"),
        [("ATSLINKID", "ATSLINKID")],
        columns=["ATSAUTHORIZATIONNUMBER", "ATS_LANDSFILENUMBER", "DISPOSITION_TRANSACTION_SID"],
    )
    return lookup(linked, areas, [("ATSAUTHORIZATIONNUMBER", "ATSAUTHORIZATIONNUMBER")],
                  columns=["BUSINESSAREANUMBER"])


def applications_with_dispositions(applications: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Applications and the decoded disposition each one names."""
    left = applications.select(
        "APPLICANT", "SUBMITTER", "AUTHORIZATIONTYPE", "APPLICATIONTYPE",
        F.col("STATUS").alias("STATUS_V"),
        text.without_line_breaks(F.col("STATUSSHOWNTOCLIENT")).alias("STATUS_VISIBLE_V"),
        "TRACKINGNUMBER", "ATSLINKID", "ATSAUTHORIZATIONNUMBER", "ATSPROJECTNUMBER", "LANDSFILENUMBER",
        F.col("DISPOSITION_TRANSACTION_SID").alias("DISPOSITION_TRANSACTION_SID_V"),
        "BUSINESSAREA", "BUSINESSAREANUMBER", "OFFICE",
        *[F.col(c).alias(f"{c}_V") for c in ("CREATEDDATE", "SUBMITTEDDATE", "RECEIVEDDATE", "DATECOMPLETED")],
    )
    right = dispositions.drop("APPLICATION_TYPE_CDE")
    return left.join(right, left["DISPOSITION_TRANSACTION_SID_V"] == right["DISPOSITION_TRANSACTION_SID"])


def disposition_keys(t: DispositionTables) -> DataFrame:
    """Counted transactions that have a disposition, a unit and a current status."""
    kept = matching(
        counted_transactions(t.transactions),
        (t.dispositions, [("DISPOSITION_SID", "DISPOSITION_SID")]),
        (t.org_units, [("ORG_UNIT_SID", "ORG_UNIT_SID")]),
        (current_statuses(t.statuses), [("DISPOSITION_TRANSACTION_SID", "DISPOSITION_TRANSACTION_SID")]),
    )
    key = F.col("DISPOSITION_TRANSACTION_SID").try_cast("bigint")
    return kept.select(key.alias("DISPOSITION_TRANSACTION_SID")).filter(
        F.col("DISPOSITION_TRANSACTION_SID").isNotNull()
    )


def applications_only(applications: DataFrame, links: DataFrame, t: DispositionTables, system_id: str,
                      id_column: str, business_area: str = LAND_BUSINESS_AREA) -> DataFrame:
    """Land applications without a counted disposition, best row per id, in the shared layout."""
    raw = lookup(
        land_applications(applications, business_area).drop("LANDSFILENUMBER"),
        links,
        [("ATSLINKID", "ATSLINKID")],
        columns=["ATSAUTHORIZATIONNUMBER", "LANDSFILENUMBER", "DISPOSITION_TRANSACTION_STRING"],
    )
    named = raw.withColumns({
        "DISPOSITION_TRANSACTION_SID_V": numbers.to_bigint(F.col("DISPOSITION_TRANSACTION_STRING")),
        id_column: text.first_present(
            [F.col(c) for c in ("JOBID", "TRACKINGNUMBER", "ATSLINKID", "ATSAUTHORIZATIONNUMBER")]
        ),
    }).filter(F.col(id_column).isNotNull())
    alone = without_match(
        named, disposition_keys(t), [("DISPOSITION_TRANSACTION_SID_V", "DISPOSITION_TRANSACTION_SID")]
    )
    best = keep_first(alone, [id_column], _best_first(alone))
    return _in_shared_layout(best, system_id, id_column)


def _best_first(rows: DataFrame) -> list[Column]:
    """Rows that name a transaction first, then the latest, then the highest identifiers."""
    newest = F.coalesce(*[
        dates.to_second(*column_of(rows, c))
        for c in ("DATECOMPLETED", "RECEIVEDDATE", "SUBMITTEDDATE", "CREATEDDATE")
    ])
    identifiers = [
        text.blank_to_null(F.col(c)) for c in ("ATSAUTHORIZATIONNUMBER", "TRACKINGNUMBER", "ATSLINKID")
    ]
    # The last two only settle full ties, so that every run keeps the same row.
    ties = [F.col("DISPOSITION_TRANSACTION_STRING"), F.col("LANDSFILENUMBER")]
    return [
        F.col("DISPOSITION_TRANSACTION_SID_V").isNotNull().desc(),
        *[newest_first(c) for c in (newest, *identifiers, *ties)],
    ]


def _in_shared_layout(rows: DataFrame, system_id: str, id_column: str) -> DataFrame:
    known = {
        "system_id": F.lit(system_id),
        "CREATEDDATE": dates.to_second(*column_of(rows, "CREATEDDATE")),
        "SUBMITTEDDATE": dates.to_second(*column_of(rows, "SUBMITTEDDATE")),
        "APPLICATION_RECEIVED_DATE": dates.to_second(*column_of(rows, "RECEIVEDDATE")),
        "COMPLETED_DAT": dates.to_second(*column_of(rows, "DATECOMPLETED")),
        "ATSAUTHORIZATIONNUMBER": text.blank_to_null(F.col("ATSAUTHORIZATIONNUMBER")),
        "ATSAUTHORIZATIONNUMBER_RAW": F.col("ATSAUTHORIZATIONNUMBER"),
        "STATUS_V": F.col("STATUS"),
        "STATUS_VISIBLE_V": text.without_line_breaks(F.col("STATUSSHOWNTOCLIENT")),
        **{f"{c}_V": F.col(c) for c in ("CREATEDDATE", "SUBMITTEDDATE", "RECEIVEDDATE", "DATECOMPLETED")},
        **{c: F.col(c) for c in (
            "JOBID", "APPLICANT", "SUBMITTER", "AUTHORIZATIONTYPE", "APPLICATIONTYPE", "TRACKINGNUMBER",
            "ATSLINKID", "ATSPROJECTNUMBER", "LANDSFILENUMBER", "DISPOSITION_TRANSACTION_STRING",
            "DISPOSITION_TRANSACTION_SID_V", "BUSINESSAREA", "BUSINESSAREANUMBER", "OFFICE",
        )},
    }
    return rows.select(
        F.col(id_column),
        *[known.get(c, F.lit(None).cast(layout_type(c))).alias(c) for c in SHARED_LAYOUT],
    )


def application_staging(application_rows: DataFrame, id_column: str) -> DataFrame:
    """Application-only rows ready for the event job: id replaced by the tracking number,
    exact layout, every column converted."""
    types = {c: layout_type(c) for c in SHARED_LAYOUT}
    rows = fixed_layout(application_rows, (id_column, *SHARED_LAYOUT))
    tracking, tracking_type = column_of(rows, "TRACKINGNUMBER")
    return rows.select(
        text.plain_text(tracking, tracking_type).alias(id_column),
        *[converted(*column_of(rows, c), types[c]).alias(c) for c in SHARED_LAYOUT],
    )


def applications_with_authorizations(applications: DataFrame, links: DataFrame, areas: DataFrame,
                                     authorizations: DataFrame, close_reasons: DataFrame,
                                     statuses: DataFrame) -> DataFrame:
    """All applications with their authorization, its status and close reason spelled out.

    The area table adds no column, but an application with several areas appears once per area. So areas are counted,
    and rows are repeated last: joins carry one row for each link and authorization, and of the applications only what
    they have themselves.
    """
    number, times = "ATSAUTHORIZATIONNUMBER", "__areas"
    counted = areas.groupBy(number).agg(F.count(F.lit(1)).alias(times))
    linked = links.select("ATSLINKID", number, "LANDSFILENUMBER", "DISPOSITION_TRANSACTION_STRING")
    linked = lookup(linked, counted, [(number, number)], columns=[times])
    linked = lookup(linked, authorizations, [(number, "AUTHORIZATION_ID")], columns=[
        "PROJECT_ID", "FILE_NUMBER", "AUTHORIZATION_STATUS_CODE", "ATHN_CLOSE_REASON_CODE",
        "APPLICATION_RECEIVED_DATE", "APPLICATION_ACCEPTED_DATE", "APPLICATION_REJECTED_DATE",
        "FIRST_NATION_START_DATE", "FIRST_NATION_COMPLETION_DATE", "TECH_REVIEW_COMPLETION_DATE",
        "ADJUDICATION_DATE",
    ])
    linked = decode(linked, close_reasons, [("ATHN_CLOSE_REASON_CODE", "ATHN_CLOSE_REASON_CODE")],
                    {"DESCRIPTION": "ATHN_CLOSE_REASON_DESC"})
    linked = decode(linked, statuses, [("AUTHORIZATION_STATUS_CODE", "AUTHORIZATION_STATUS_CODE")],
                    {"DESCRIPTION": "AUTHORIZATION_STATUS_DESC"})
    brought = [c for c in linked.columns if c != "ATSLINKID"]
    rows = lookup(applications.drop("LANDSFILENUMBER"), linked, [("ATSLINKID", "ATSLINKID")], columns=brought)
    return repeated(rows, F.coalesce(times, F.lit(1))).select(
        "JOBID", "TRACKINGNUMBER", "ATSLINKID", number, "ATSPROJECTNUMBER", "PROJECT_ID", "LANDSFILENUMBER",
        "FILE_NUMBER", "DISPOSITION_TRANSACTION_STRING", "EXTERNALREFERENCE", "EXTERNALJOBNUMBER",
        "EXTERNALJOBNUMBER2", "MINENUMBER", "BUSINESSAREA", "BUSINESSAREANUMBER", "OFFICE", "APPLICANT",
        "SUBMITTER", "AUTHORIZATIONTYPE", "APPLICATIONTYPE", "STATUS", "STATUSSHOWNTOCLIENT",
        "AUTHORIZATION_STATUS_CODE", "AUTHORIZATION_STATUS_DESC", "ATHN_CLOSE_REASON_CODE",
        "ATHN_CLOSE_REASON_DESC", "CREATEDDATE", "SUBMITTEDDATE", "APPLICATION_RECEIVED_DATE", "RECEIVEDDATE",
        "APPLICATION_ACCEPTED_DATE", "APPLICATION_REJECTED_DATE", "DATECOMPLETED", "FIRST_NATION_START_DATE",
        "FIRST_NATION_COMPLETION_DATE", "TECH_REVIEW_COMPLETION_DATE", "ADJUDICATION_DATE",
    )
