"""Redacted views for sharing: which columns of which table may leave."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shape import allow_list
from .tables import REBASE_LEGACY, materialise_view, read_table

# Audit columns that close most riparian tables, and the processes that are shared.
AUDIT = ("WHO_CREATED", "WHEN_CREATED", "WHO_UPDATED", "WHEN_UPDATED")
SHARED_PROCESSES = (
    "p_AR_AuthorizePermits",
    "p_AR_RecordResponse",
    "p_AR_ChangeStatus",
    "p_AR_EnterApplication",
    "p_AR_HoldOnOff",
    "p_AR_ReviewAmendmentRequest",
    "p_AR_NoticeOfPermitReportFail",
    "p_AR_SendPermitReport",
    "p_AR_EvaluateComments",
    "p_AR_RecommendPermitIssueRej",
    "p_AR_AssignPermitApplication",
    "p_AR_ReviewRecommendations",
    "p_AR_ReviewApplication",
    "p_AR_IssuePermit",
    "p_AR_ValidatePermitReport",
    "p_AR_InviteComments",
    "p_AR_SendCommentReminders",
    "p_AR_RequestInformation",
)


@dataclass(frozen=True)
class ShareSpec:
    """One shared view: source table, columns let through, dates cleaned, rows kept."""

    view: str
    source: str
    columns: tuple[str, ...]
    clean_dates: tuple[str, ...] = ()
    only: tuple[str, tuple[str, ...]] | None = None


def shared_rows(table: DataFrame, spec: ShareSpec) -> DataFrame:
    """The rows and columns a view lets through; both choices reach the scan."""
    if spec.only:
        column, values = spec.only
        table = table.filter(F.col(column).isin(*values))
    return allow_list(table, spec.columns, spec.clean_dates)


def publish_share(tables: Mapping[str, DataFrame], spec: ShareSpec, schema: str, fmt: str = "parquet") -> DataFrame:
    """Stores the view unless it exists."""
    return materialise_view(shared_rows(tables[spec.source], spec), f"{schema}.{spec.view}", fmt)


def share_stored(spark: SparkSession, folder: str, spec: ShareSpec, schema: str, fmt: str = "parquet") -> DataFrame:
    """Stores the view of a table kept below ``folder``. The sources have timestamps of the old calendar."""
    table = read_table(spark, posixpath.join(folder, spec.source), fmt, REBASE_LEGACY)
    return publish_share({spec.source: table}, spec, schema, fmt)


def _permit_view(view: str, columns: str, clean: str = "", only=None) -> ShareSpec:
    source = view.removesuffix("_redacted").removesuffix("_subset")
    return ShareSpec(view, source, tuple(columns.split()), tuple(clean.split()), only)


def _riparian_view(view: str, columns: str, after: str = "", dates: str = "", audit: tuple[str, ...] = AUDIT) -> ShareSpec:
    """Columns, then the audit columns, then any that follow; audit dates are always cleaned."""
    clean = (*dates.split(), *(c for c in audit if c.startswith("WHEN_")))
    return ShareSpec(
        view, view.removesuffix("_redacted"), (*columns.split(), *audit, *after.split()), clean
    )


def _code_view(view: str, code: str, extra: str = "") -> ShareSpec:
    return _riparian_view(view, f"{code} DESCRIPTION {extra}")


# The shared permit views and their columns.
PERMIT_VIEWS: tuple[ShareSpec, ...] = (
    _permit_view(
        "apts_amsprocesses_subset",
        """PROCESSID CREATEDDATE JOBID DATECOMPLETED OBJECTDEFDESCRIPTION OUTCOME PROCESSTYPEID
        COMPLETEDBYUSERID OBJECTID PROCESSNAME""",
        clean="CREATEDDATE",
        only=("PROCESSNAME", SHARED_PROCESSES),
    ),
    _permit_view(
        "apts_ar_permitammendmentrequest_redacted",
        "OBJECTID COMPLETIONDATE PERMITJOBID REQUESTEDDATE REQUESTNUMBER STATUS AMENDMENTTYPEID",
        clean="COMPLETIONDATE",
    ),
    _permit_view("apts_ar_bordennumber", "OBJECTID BORDENNUMBER"),
    _permit_view("apts_ar_mapsheet", "OBJECTID ACTIVE MAPSHEETPREFIX MAPSHEETSUFFIX"),
    _permit_view(
        "apts_ar_party_redacted",
        """OBJECTID ACTIVE ADDRESSLINE1 ADDRESSLINE2 AGENCY ALTERNATENAME CITY COUNTRY
        EXTERNALAPPLICANT FIRSTNATIONAFFILIATION FIRSTNATIONSYNONYM ISARCHAEOLOGIST ISFIRSTNATION
        ISSYSTEMADMINISTRATOR ORGANIZATIONNAME PARTYROLE POSITIONTITLE PROVINCE RELATEDASSIGNMENT
        TYPE USERID WORKAUTHORIZATIONOBJECTID""",
    ),
    _permit_view(
        "apts_ar_archaeologypermitjob_redacted",
        """JOBID ADDDEVELOPMENTAREA ADDFIELDDIRECTOR ADDPROPONENT AMENDMENTAPPROVEDDATE
        APPLICATIONNUMBER APPLICATIONRECEIVEDDATE APPLICATIONREVISED DATEASSIGNEDTOPO
        DELIVERABLESDUEDATE ISSUEDATE PERMITEXPIRYDATE PERMITNUMBER PERMITTYPEOBJECTID
        POREVIEWCOMPLETEDDATE POREVIEWDUEDATE PROJECTOFFICERID STATUSDESCRIPTION PROJECTTYPEID
        ISSUINGAGENCYID PROPONENTOBECTID SECTOROBJECTID""",
    ),
    _permit_view(
        "apts_ar_permitparticipant_redacted",
        "OBJECTID JOBID AFFILIATIONOBJECTID PARTYOBJECTID ROLEOBJECTID",
    ),
    _permit_view("apts_ar_permitrelatedfile_redacted", "OBJECTID REFERENCENUMBER JOBID FILETYPEID"),
    _permit_view("apts_ar_permittobordennumberxref", "RELATIONSHIPID PERMITJOBID BORDENNUMBEROBJECTID"),
    _permit_view(
        "apts_ar_permittogeographareaxref", "RELATIONSHIPID PERMITJOBID GEOGRAPHICALAREAOBJECTID"
    ),
    _permit_view(
        "apts_ar_permittointerestedpartyxref",
        "RELATIONSHIPID PERMITJOBID INTERESTEDPARTYOBJECTID COMMENTSREQUIRED",
    ),
    _permit_view("apts_ar_permittomapsheetxref", "RELATIONSHIPID PERMITJOBID MAPSHEETOBJECTID"),
    _permit_view("apts_ar_permittype", "OBJECTID ACTIVE EXTERNALCANCREATE OGCCANCREATE PERMITTYPE"),
    _permit_view(
        "apts_ar_processes_redacted",
        """PROCESSID CREATEDDATE DATECOMPLETED JOBID OUTCOME SCHEDULEDCOMPLETEDATE
        SCHEDULEDSTARTDATE OBJECTDEFDESCRIPTION""",
        clean="CREATEDDATE",
    ),
    _permit_view("apts_ar_systemtable", "OBJECTID ACTIVE SYSTEMTABLETYPE VALUE"),
)

# The shared riparian views and their columns.
RIPARIAN_VIEWS: tuple[ShareSpec, ...] = (
    _riparian_view(
        "rar_people_redacted",
        """PERSON_ID PROFESSIONAL_DESIGNATION_CODE ADDRESS_ID PERSON_CODE FIRST_NAME MIDDLE_NAME
        LAST_NAME PHONE_NUMBER EMAIL_ADDRESS COMPANY_NAME""",
        after="REGISTRATION_NUMBER",
    ),
    _riparian_view(
        "rar_dev_assess_status_audit",
        "DEV_ASSESS_STATUS_AUDIT_ID DEV_ASSESSMENT_ID OLD_STATUS_CODE NEW_STATUS_CODE",
        audit=("WHO_CREATED", "WHEN_CREATED"),
    ),
    _riparian_view(
        "rar_addresses",
        """ADDRESS_ID ADDRESS_LINE_1 ADDRESS_LINE_2 ADDRESS_LINE_3 CITY PROVINCE_STATE POSTAL_CODE
        COUNTRY""",
    ),
    _riparian_view(
        "rar_dev_assessment_docs",
        "DEV_ASSESSMENT_DOC_ID DEV_ASSESSMENT_ID DOCUMENT_NAME UPLOAD_DATE",
        after="DOCUMENT_TYPE",
        dates="UPLOAD_DATE",
    ),
    _riparian_view("rar_dev_assessment_people_xref", "DEV_ASSESSMENT_ID PERSON_ID PRIMARY_YN"),
    _riparian_view(
        "rar_dev_assessments",
        """DEV_ASSESSMENT_ID DEV_NATURE_CODE ADDRESS_ID REGION_CODE STREAM_CODE MUNICIPALITY_CODE
        DEV_CODE RIPARIAN_AREA_LENGTH PROPOSED_START_DATE PROPOSED_END_DATE LOCATION_LEGAL_DSC
        LOCATION_STREAM_NAME LOCATION_NEW_WATERSHED_CODE LOCATION_LATITUDE LOCATION_LONGITUDE
        LOT_AREA SECTION_9_PART_7_ACTIVITIES_YN ALL_PROFESSIONALS_QUALIFIED_YN
        ASSESSMENT_METHOD_FOLLOWED_YN CERTIFIED_NO_HADD_YN COMPLETE_REPORT_ATTACHED_YN
        REVISION_NUMBER""",
        after="DEV_AREA DFO_AREA_CODE RETAIN_ASSESS_REPORT_YN DEV_STATUS_CODE",
        dates="PROPOSED_START_DATE PROPOSED_END_DATE",
    ),
    _code_view("rar_dev_cds", "DEV_CODE"),
    _code_view("rar_dev_nature_cds", "DEV_NATURE_CODE"),
    _code_view("rar_dev_status_cds", "DEV_STATUS_CODE"),
    _code_view("rar_dfo_area_cds", "DFO_AREA_CODE", "EMAIL_ADDRESS"),
    _riparian_view(
        "rar_government_file_ref_nos",
        "GOVERNMENT_FILE_REF_NO_ID DEV_ASSESSMENT_ID GOVERNMENT_FILE_REF_NO",
    ),
    _code_view("rar_municipalities", "MUNICIPALITY_CODE", "EMAIL_ADDRESS"),
    _code_view("rar_person_cds", "PERSON_CODE"),
    _code_view("rar_professional_designations", "PROFESSIONAL_DESIGNATION_CODE"),
    _code_view("rar_region_cds", "REGION_CODE", "EMAIL_ADDRESS"),
    _code_view("rar_stream_type_cds", "STREAM_TYPE_CODE"),
)
