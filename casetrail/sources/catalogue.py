"""The tables a full refresh copies, by source system.

A landed name is the prefix and the source name in lower case; exceptions are listed. Nine tables
land by a column mapping, listed below; the others as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from .replicate import LANDED_TYPES, ReplicaSpec


@dataclass(frozen=True)
class SystemTables:
    schema: str
    target: str
    prefix: str
    names: str
    renamed: dict[str, str] = field(default_factory=dict)
    other_schemas: dict[str, str] = field(default_factory=dict)

    def specs(self) -> list[ReplicaSpec]:
        return [
            ReplicaSpec(
                self.other_schemas.get(n, self.schema), n, self.target,
                self.renamed.get(n, self.prefix + n.lower()), _mapping(n),
            )
            for n in self.names.split()
        ]


def _mapping(table: str) -> tuple[tuple[str, str, str], ...]:
    """(source, target, type) of each mapped column; names stay as they are."""
    pairs = [entry.split() for entry in MAPPED_COLUMNS.get(table, "").split(",") if entry.strip()]
    return tuple((name, name, LANDED_TYPES.get(kind, kind.replace(";", ","))) for name, kind in pairs)


# Columns and landed types of the mapped tables (of a decimal: digits;decimals).
MAPPED_COLUMNS: dict[str, str] = {
    "ER_AUTHORIZATION": """
        OBJECTID long, AGENCYFILENUMBER string, AGENCYOBJECTID long, AUTHORIZATIONAOI string, AUTHREFERRALTYPEID long,
        PROJECTOBJECTID long""",
    "ER_AUTHORIZATION_REFERRAL": """
        RELATIONSHIPID long, AUTHORIZATIONOBJECTID long, REFERRALJOBID long, AUTHORIZATIONAOI string""",
    "HARVESTING_AUTHORITY": """
        HVA_SKEY long, FOREST_FILE_ID string, CUTTING_PERMIT_ID string, HARVESTING_AUTHORITY_ID string,
        FOREST_DISTRICT long, DISTRICT_ADMN_ZONE string, GEOGRAPHIC_DISTRICT long, MGMT_UNIT_ID string,
        MGMT_UNIT_TYPE_CODE string, LICENCE_TO_CUT_CODE string, HARVEST_TYPE_CODE string,
        HARVEST_AUTH_STATUS_CODE string, TENURE_TERM integer, EXTEND_COUNT long,
        HARVEST_AUTH_EXTEND_REAS_CODE string, QUOTA_TYPE_CODE string, CROWN_LANDS_REGION_CODE string,
        SALVAGE_TYPE_CODE string, CASCADE_SPLIT_CODE string, CATASTROPHIC_IND string, CROWN_GRANTED_IND string,
        CRUISE_BASED_IND string, DECIDUOUS_IND string, BCAA_FOLIO_NUMBER string, LOCATION string,
        HIGHER_LEVEL_PLAN_REFERENCE string, HARVEST_AREA double, REVISION_COUNT integer, ENTRY_USERID string,
        ENTRY_TIMESTAMP timestamp, UPDATE_USERID string, UPDATE_TIMESTAMP timestamp,
        IS_WASTE_ASSESSMENT_REQUIRED string, IS_CP_EXTENSN_APPL_FEE_WAIVED string,
        IS_CP_EXTENSION_APPL_FEE_PAID string, IS_WITHIN_FIBRE_RECOVERY_ZONE string, HARVESTING_AUTHORITY_GUID binary""",
    "TIMBER_MARK": """
        TIMBER_MARK string, FOREST_FILE_ID string, CUTTING_PERMIT_ID string, FOREST_DISTRICT long,
        GEOGRAPHIC_DISTRCT long, CASCADE_SPLIT_CODE string, QUOTA_TYPE_CODE string, DECIDUOUS_IND string,
        CATASTROPHIC_IND string, CROWN_GRANTED_IND string, CRUISE_BASED_IND string, CERTIFICATE string,
        HDBS_TIMBER_MARK string, VM_TIMBER_MARK string, TENURE_TERM integer, BCAA_FOLIO_NUMBER string,
        ACTIVATED_USERID string, AMENDED_USERID string, DISTRICT_ADMN_ZONE string, LANDS_REGION string,
        CROWN_GRANTED_ACQ_DESC string, MARK_STATUS_ST string, MARK_EXTEND_RSN_CD string, MARK_EXTEND_COUNT long,
        MARKNG_INSTRMNT_CD string, MARKING_METHOD_CD string, ENTRY_USERID string, ENTRY_TIMESTAMP timestamp,
        UPDATE_USERID string, UPDATE_TIMESTAMP timestamp, REVISION_COUNT integer, SMALL_PATCH_SALVAGE_IND string,
        SALVAGE_TYPE_CODE string""",
    "RAR_DEV_ASSESSMENT_DOCS": """
        DEV_ASSESSMENT_DOC_ID decimal(20;0), DEV_ASSESSMENT_ID decimal(20;0), DOCUMENT_NAME string,
        DOCUMENT_TYPE string, UPLOAD_DATE timestamp, WHO_CREATED string, WHEN_CREATED timestamp, WHO_UPDATED string,
        WHEN_UPDATED timestamp""",
    "VFCBC_APPLICATION_VW": """
        JOBID long, TRACKINGNUMBER string, BUSINESSAREANUMBER string, ATSLINKID long, ATSPROJECTNUMBER string,
        EXTERNALREFERENCE string, EXTERNALJOBNUMBER string, EXTERNALJOBNUMBER2 string, MINENUMBER string,
        LANDSFILENUMBER string, SUBMITTER string, APPLICANT string, AUTHORIZATIONTYPE string, APPLICATIONTYPE string,
        CREATEDDATE timestamp, STATUS string, OFFICE string, BUSINESSAREA string, SUBMITTEDBYTYPE string,
        STATUSSHOWNTOCLIENT string, SUBMITTEDDATE timestamp, RECEIVEDDATE timestamp, DATECOMPLETED timestamp""",
    "VFCBC_ATSNUMBER_VW": """
        ATSLINKID long, ATSAUTHORIZATIONNUMBER integer, LANDSFILENUMBER integer, DISPOSITION_TRANSACTION_SID integer,
        DISPOSITION_TRANSACTION_STRING string""",
    "VFCBC_PROCESSES": """
        OBJECTID long, CREATEDDATE timestamp, DATECOMPLETED timestamp, JOBID long, OUTCOME string, PROCESSTYPE string,
        STAFFASSIGNED string""",
    "ATIS_WATERJOB_COMBINED_MV": """
        UNIQUEID integer, VFCBCOBJECTID integer, AUTHORIZATIONID decimal(38;18), VFCTRACKING_NUMBER string,
        WATEROBJECTID integer, JOBNUMBER string, FILENUMBER string, LICENCENUMBER string, VFCAPPSTATUS string,
        ATSAUTHORIZATIONSTATUS string, WATERJOBSTATUS string, VFCBCJOBSTATUS string, STATUSTRANSFORMED string,
        JOBSTATUSGROUP string, APPJOBOPEN string, APPROVALLICENCESTATUS string, REGION string,
        REGIONTRANSFORMED string, VFCBCOFFICE string, WATEROFFICE string, DISTRICTPRECINCT string, JOBTYPE string,
        JOBSUBTYPE string, JOBTYPETRANSFORMED string, JOBTYPEGROUP string, CLIENTNAME string, WATERSHEDNAME string,
        USETYPE string, DIVERSIONTYPE string, CIATYPE string, DIVERSIONSOURCE string, PURPOSEUSENAME string,
        PURPOSEUSECODE string, JOBCURRENTLYASSIGNEDTO string, RECEIVEDDATE timestamp, FCBCACCEPTEDDATE timestamp,
        FCBCCOMPLETEDATE timestamp, FCBCPROCESSINGTIME float, FNCONSULTTIME float, FNCONSULTCOMPLETE string,
        PROCESSSTATUS string, PRELIMREVIEWCOMPLETEDATE timestamp, PRELIMREVIEWNETTIME float,
        TECHASSESSMENTCOMPLETEDATE timestamp, TECHASSESSMENTNETTIME float, LEGALCHECKCOMPLETEDATE timestamp,
        LEGALCHECKCOMPLETENETTIME float, GRANTEDREFUSEDATE timestamp, GRANTREFUSECOMPLETENETTIME float,
        ATSDECISIONDATE timestamp, TOTALTIMEFORDECISION float, CURRENTPARKTIME float, TOTALPARKTIME float,
        NETTIMEFORDECISION float""",
}

# Source names, schemas and prefixes of the copied tables, job by job.
SYSTEMS: dict[str, SystemTables] = {
    "archaeology permits": SystemTables(
        "ARCHAEOLOGY_CORRAL_VIEWS", "apts_replication", "apts_",
        """
        AR_ARCHAEOLOGYPERMITJOB AR_BORDENNUMBER AR_MAPSHEET AR_PARTY AR_PERMITAMMENDMENTREQUEST
        AR_PERMITPARTICIPANT AR_PERMITRELATEDFILE AR_PERMITTOBORDENNUMBERXREF
        AR_PERMITTOGEOGRAPHAREAXREF AR_PERMITTOINTERESTEDPARTYXREF AR_PERMITTOMAPSHEETXREF
        AR_PERMITTYPE AR_PROCESSES AR_SYSTEMTABLE AMSPROCESSES
        """,
        other_schemas={"AMSPROCESSES": "CORRAL_GENERATED_VIEWS"},
    ),
    "authorization codes": SystemTables(
        "ATS", "ats_replication", "",
        """
        ATS_ATHN_CLOSE_REASON_CODES ATS_ATHN_ON_HOLD_REASON_CODES ATS_AUTHORIZATION_STATUS_CODES
        ATS_ENQUIRY_METHOD_CODES ATS_ENQUIRY_TYPE_CODES ATS_PROJECT_STATUS_CODES
        ATS_PROJECT_TYPE_CODES
        """,
        {"ATS_ATHN_ON_HOLD_REASON_CODES": "ats_athn_on_hold_reasons_code"},
    ),
    "park use jobs": SystemTables(
        "CORRAL_GENERATED_VIEWS", "epups_replication", "",
        """
        PU_AMEND_RENEWAL_TRANSFERJOB PU_AUTHORIZATIONJOB PU_PERMITANNUALFEEJOB
        PU_PERMITAPPLICATIONJOB PU_PERMITCANCELLATIONJOB PU_PERMITCANCELWARNINGJOB
        PU_PERMITCONDITIONNOTIFJOB PU_PERMITDATACOLLECTIONJOB PU_PERMITEXPIRATIONJOB
        PU_PERMITREINSTATEMENTJOB PU_PERMITSTATEUPDATEJOB PU_PERMITSUSPENSIONJOB
        PU_RENEWALNOTIFICATIONJOB
        """,
        {
            "PU_AUTHORIZATIONJOB": "epups_pu_authorizationjob",
            "PU_PERMITANNUALFEEJOB": "epups_pu_permitannualfeejob",
        },
    ),
    "park use": SystemTables(
        "CORRAL_GENERATED_VIEWS", "epups_replication", "",
        """
        PU_ACTIVITY PU_ACTIVITYCATEGORY PU_AUTHORIZATION PU_AUTHORIZATIONTYPE
        PU_DRAFTAUTHORIZATION PU_EXPIREDPERMITREACTIVATION PU_MANAGEMENTAREA PU_PROTECTEDLAND
        PU_PURPOSE PU_REGION PU_REGIONPARENT
        """,
    ),
    "park use links": SystemTables(
        "CORRAL_GENERATED_VIEWS", "epups_replication", "",
        """
        PU_ACTIVITYAUTHTYPEXREF PU_APPLICATIONUSEAPPLFEEXREF PU_APPLICATIONUSEAUTHTYPEXREF
        PU_AUTHOBJECTCONTACTSXREF PU_AUTHOBJECTCOPERMITTEEXREF PU_AUTHOBJECTPROTECTEDLANDXREF
        PU_AUTHOBJPRIMARYACTIVITYXREF PU_AUTHOBJREPPURPOSEDATAXREF PU_AUTHTYPEMAJORFEEXREF
        PU_AUTHTYPEMINORFEEXREF PU_AUTHTYPETECHREVTASKTEMPXREF PU_AUTHTYPETRANSFERFEEXREF
        PU_MGMTAREAPROTECTLANDXREF PU_PERMITEXPSECTHEADXREF PU_PERMITSTAFFXREF
        PU_REGIONMGMTAREAXREF
        """,
    ),
    "referrals": SystemTables(
        "CORRAL_GENERATED_VIEWS", "ereferral_replication", "",
        """
        ER_AUTHORIZATION ER_AUTHORIZATION_REFERRAL ER_AGENCY ER_ADMINISTRATIVEREGION
        ER_CLASSIFICATION ER_PROJECT ER_PROJECT_REFERRAL ER_RECIPIENTAGENCY ER_RECIPIENTDIRECT
        ER_REFERRAL ER_REFERRALAGENCY ER_REFERRALAGENCYREP ER_REFERRALANSWER ER_REFERRALCENTER
        ER_REFERRALQUESTION ER_REFERRALREQUEST
        """,
    ),
    "referral answers": SystemTables(
        "CORRAL_GENERATED_VIEWS", "ereferral_replication", "",
        """
        ER_REFERRALREQUESTANSWER ER_REFERRALRESPONSE ER_REFERRALSUMRECOMMENDATION ER_REFERRALTYPE
        ER_REFERRALTYPECLASSIFICATION ER_REFERRALTYPESTANDARDCLAUSES ER_REFREQUESTRECOMMENDATION
        ER_REFTYPEREQUESTRECOMMENDATIO ER_REFTYPESUMRECOMMENDATION ER_REQUESTRECOMMENDATION
        ER_REQUESTRECOMMENDATIONTYPE ER_STANDARDCLAUSES ER_SUMMARY ER_SUMMARYRECOMMENDATION
        ER_SUMMARYRECOMMENDATIONTYPE
        """,
        {
            "ER_REFERRALSUMRECOMMENDATION": "er_referralsummaryrecommendation",
            "ER_REFERRALTYPESTANDARDCLAUSES": "er_referraltypesstandardclauses",
        },
    ),
    "tenure codes": SystemTables(
        "THE", "fta_replication", "fta_",
        """
        AAC_ADJUSTMENT_REASON_CODE AAC_FILE_TYPE_CODE ALLOWABLE_AREA_TYPE_CODE
        ALLOWABLE_CUT_TYPE_CODE BLOCK_STATUS_CODE CUT_REGULATION_CODE FILE_TYPE_CODE
        FIRE_HARVESTING_REASON_CODE HARVEST_AUTH_STATUS_CODE HARVEST_TYPE_CODE
        HARVEST_UNIT_OF_MEASURE_CODE LICENCE_TO_CUT_CODE MGMT_UNIT_TYPE_CODE
        OCCUPANT_LICENCE_TO_CUT_CODE REFOREST_DECLARE_TYPE_CODE SALE_METHOD_CODE SB_CATEGORY_CODE
        SPECIAL_USE_CODE TENURE_APPLICATION_PURP_CODE TENURE_APPLICATION_STATE_CODE
        TENURE_APPLICATION_TYPE_CODE TENURE_EXTEND_REASON_CODE TENURE_FILE_STATUS_CODE
        TENURE_STATUS_CODE TFL_NUMBER_CODE TSA_NUMBER_CODE
        """,
    ),
    "tenures": SystemTables(
        "THE", "fta_replication", "fta_",
        """
        AAC_ALLOCATION_AMOUNT AAC_ALLOCATION_PERIOD ASSOCIATED_TENURE CUT_BLOCK FOREST_FILE_CLIENT
        FOREST_MGMT_UNIT HARVEST_SALE HARVESTING_AUTHORITY LICENCE_TO_CUT ORG_UNIT
        PRIVATE_MARK_CERTIFICATE PROV_FOREST_USE SPEC_USE_PERMIT TENURE_APPLICATION TENURE_TERM
        TIMBER_MARK
        """,
    ),
    "tenure geometries": SystemTables(
        "THE", "fta_replication", "fta_",
        "CUT_BLOCK_GEOM HARVEST_AUTHORITY_AMEND_GEOM HARVEST_AUTHORITY_GEOM",
    ),
    "log exports": SystemTables(
        "THE", "lexis_replication", "lexis_",
        "EXPORT_PERMIT_DETAIL EXPORT_PERMIT_STATUS_CODE",
    ),
    "riparian assessments": SystemTables(
        "RAR", "rarn_replication", "",
        """
        RAR_ADDRESSES RAR_DEV_ASSESS_STATUS_AUDIT RAR_DEV_ASSESSMENT_DOCS
        RAR_DEV_ASSESSMENT_PEOPLE_XREF RAR_DEV_ASSESSMENTS RAR_DEV_CDS RAR_DEV_NATURE_CDS
        RAR_DEV_STATUS_CDS RAR_DFO_AREA_CDS RAR_GOVERNMENT_FILE_REF_NOS RAR_MUNICIPALITIES
        RAR_PEOPLE RAR_PERSON_CDS RAR_PROFESSIONAL_DESIGNATIONS RAR_REGION_CDS RAR_STREAM_TYPE_CDS
        """,
    ),
    "road codes": SystemTables(
        "APP_RRS", "rrs_replication", "rrs_",
        """
        ROAD_APPLICATION_STATUS_CODE ROAD_CLIENT_STATUS_CODE ROAD_SECTION_STATUS_CODE
        ROAD_TENURE_STATUS_CODE ROAD_TENURE_TYPE_CODE ROAD_USE_PERMIT_PURPOSE_CODE
        ROAD_USE_PERMIT_STATUS_CODE SUBMISSION_STATUS_CODE
        """,
    ),
    "roads": SystemTables(
        "APP_RRS", "rrs_replication", "rrs_",
        """
        RESOURCE_ROAD_CLIENT_SDW RESOURCE_ROAD_TENURE ROAD_APPL_MAP_FEATURE ROAD_APPLICATION
        ROAD_EXTERNAL_SUBMSN_SDW ROAD_FEATURE_CLASS_SDW ROAD_FOREST_MGT_UNIT_SDW ROAD_ORG_UNIT_SDW
        ROAD_REQUEST ROAD_SECTION ROAD_SUBMISSION ROAD_TENURE_CLIENT ROAD_USE_PERMIT
        ROAD_USE_PERMIT_SECTION RR_ASSOCIATED_TENURE
        """,
    ),
    "applications": SystemTables(
        "CORRAL_GENERATED_VIEWS", "vfcbc_replication", "",
        """
        VFCBC_APPLICATION VFCBC_APPLICATION_VW VFCBC_ATSNUMBER_VW VFCBC_BUSINESS
        VFCBC_BUSINESSAREA VFCBC_CROWNLANDTENUREAPPAREA VFCBC_PROCESSES VFCBC_OFFICE
        VFCBC_NOWAMENDSTEP4 VFCBC_NOWAPPLICATIONXREF
        """,
        {"VFCBC_PROCESSES": "vfcbc_process"},
    ),
    "water jobs": SystemTables("WATERDW", "wma_replication", "", "ATIS_WATERJOB_COMBINED_MV"),
}


def replica_specs(*systems: str) -> list[ReplicaSpec]:
    """Specifications of the named systems, of all of them if none is named."""
    return [spec for name in (systems or SYSTEMS) for spec in SYSTEMS[name].specs()]
