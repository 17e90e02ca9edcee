"""Messy source tables made from the driver tables. All rows are kept; only values vary."""

PERMITS = """
SELECT o_orderkey AS PERMIT_ID,
       CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN ' Null' ELSE o_orderstatus END AS STATUS,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS RECEIVED,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL
            WHEN o_orderkey % 13 = 0 THEN o_orderdate - INTERVAL 10 DAY
            ELSE o_orderdate + INTERVAL 30 DAY END AS DECIDED,
       CASE o_orderkey % 6
            WHEN 0 THEN CAST(o_orderdate AS STRING)
            WHEN 1 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
            WHEN 2 THEN '10:30'
            WHEN 3 THEN replace(CAST(o_orderdate AS STRING), ' ', 'T') || '-08:00'
            WHEN 4 THEN '2020-13-45'
            ELSE 'soon' END AS NOTED,
       o_totalprice AS FEE,
       o_orderpriority AS PRIORITY,
       ' ' || CAST(o_custkey AS STRING) || '.0' AS AUTHORIZATION_ID,
       CASE WHEN o_orderkey % 4 = 0 THEN 'SYS-' || o_orderstatus END AS system_id
FROM {orders}"""

HOLDS = """
SELECT event_id AS AUTHORIZATION_ON_HOLD_ID,
       event_type AS ATHN_ON_HOLD_REASON_CODE,
       user_id AS AUTHORIZATION_ID,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS ON_HOLD_START_DATE,
       CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 5 DAY
            WHEN event_id % 5 = 0 THEN ts - INTERVAL 2 DAY END AS ON_HOLD_END_DATE
FROM {events}"""

TRANSACTIONS = """
SELECT o_orderkey AS DISPOSITION_TRANSACTION_SID,
       o_custkey AS DISPOSITION_SID,
       o_custkey % 30 AS ORG_UNIT_SID,
       CASE WHEN o_orderkey % 10 = 0 THEN 1 WHEN o_orderkey % 10 = 1 THEN NULL ELSE 48 + o_custkey % 5 END AS TYPE_SID,
       CASE WHEN o_orderkey % 20 = 0 THEN 101 WHEN o_orderkey % 20 = 10 THEN NULL ELSE o_custkey % 25 END AS SUBTYPE_SID,
       o_custkey % 6 AS PURPOSE_SID,
       o_custkey % 25 AS SUBPURPOSE_SID,
       o_custkey % 7 AS DISTRICT_OFFICE_SID,
       CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey - 1 END AS REPLMNT_FOR_DISP_TRANS_SID,
       CASE WHEN o_orderstatus = 'P' THEN 'AMD' ELSE 'NEW' END AS APPLICATION_TYPE_CDE,
       o_orderpriority AS MANAGING_AGENCY,
       substr(o_orderpriority, 1, 1) AS COMPLEXITY_LEVEL_CDE,
       'N' AS CROWN_GRANT_YRN,
       o_orderdate + INTERVAL 5400 DAY AS RECEIVED_DAT,
       o_orderdate + INTERVAL 5460 DAY AS COMMENCEMENT_DAT,
       o_orderdate + INTERVAL 9000 DAY AS EXPIRY_DAT,
       o_orderdate + INTERVAL 6000 DAY AS REVIEW_DAT
FROM {orders}"""

DISPOSITIONS = """
SELECT c_custkey AS DISPOSITION_SID, c_mktsegment AS ACTIVATION_CDE, c_name AS FILE_CHR FROM {customer}"""

ORG_UNITS = "SELECT n_nationkey AS ORG_UNIT_SID, n_name AS UNIT_NAME FROM {nation}"

STATUSES = """
SELECT l_orderkey AS DISPOSITION_TRANSACTION_SID,
       l_returnflag AS CODE_CHR_STATUS,
       l_linestatus AS CODE_CHR_STAGE,
       CAST(l_suppkey % 7 AS STRING) AS CODE_CHR_REASON,
       l_shipdate AS EFFECTIVE_DAT,
       CASE WHEN l_linenumber > 2 THEN l_shipdate END AS EXPIRY_DAT
FROM {lineitem}"""

TASKS = """
SELECT l_orderkey AS DISPOSITION_TRANSACTION_SID,
       CASE WHEN l_linenumber = 1 THEN l_shipdate END AS LAND_STATUS_DAT,
       CASE WHEN l_linenumber = 2 THEN l_shipdate END AS REPORTED_DAT,
       CASE WHEN l_linenumber = 3 THEN l_shipdate END AS ADJUDICATED_DAT,
       CASE WHEN l_linenumber = 4 THEN l_shipdate END AS DISALLOWED_DAT,
       CASE WHEN l_linenumber = 5 THEN l_shipdate END AS OFFERED_DAT,
       CASE WHEN l_linenumber = 6 THEN l_shipdate END AS OFFER_NOT_ACCEPTED_DAT,
       CASE WHEN l_returnflag = 'N' THEN l_shipdate END AS COMPLETED_DAT,
       CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS CANCELED_DAT
FROM {lineitem}"""

TYPES = "SELECT 48 + r_regionkey AS TYPE_SID, r_name AS TYPE_NME FROM {region}"
SUBTYPES = "SELECT 48 + n_regionkey AS TYPE_SID, n_nationkey AS SUBTYPE_SID, n_name AS SUBTYPE_NME FROM {nation}"
PURPOSES = "SELECT r_regionkey AS PURPOSE_SID, 'Purpose ' || r_name AS PURPOSE_NME FROM {region}"
SUBPURPOSES = "SELECT n_regionkey AS PURPOSE_SID, n_nationkey AS SUBPURPOSE_SID, n_name AS SUBPURPOSE_NME FROM {nation}"
OFFICES = "SELECT r_regionkey AS DISTRICT_OFFICE_SID, 'Office ' || r_name AS NAME FROM {region}"
STATUS_CODES = "SELECT DISTINCT replace(l_returnflag, 'R', '-') AS CODE_CHR, 'Status ' || l_returnflag AS STATUS_NME FROM {lineitem}"
STAGE_CODES = "SELECT DISTINCT l_linestatus AS CODE_CHR, 'Stage ' || l_linestatus AS STAGE_NME FROM {lineitem}"
REASON_CODES = "SELECT CAST(r_regionkey AS STRING) AS CODE_CHR, 'Reason ' || r_name AS REASON_DSC FROM {region}"

APPLICATIONS = """
SELECT CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey END AS JOBID,
       CASE WHEN c_custkey % 18 = 0 THEN '  ' ELSE ' T' || CAST(c_custkey AS STRING) END AS TRACKINGNUMBER,
       CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE c_custkey END AS ATSLINKID,
       'P' || CAST(c_nationkey AS STRING) AS ATSPROJECTNUMBER,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'Other' ELSE 'Crown Land Adjudication (vFCBC)' END AS BUSINESSAREA,
       CAST(c_custkey AS STRING) || '.00' AS BUSINESSAREANUMBER,
       'L' || CAST(c_custkey AS STRING) AS LANDSFILENUMBER,
       c_mktsegment AS OFFICE,
       c_name AS APPLICANT,
       'S-' || c_name AS SUBMITTER,
       'AT' || CAST(c_nationkey AS STRING) AS AUTHORIZATIONTYPE,
       'NEW' AS APPLICATIONTYPE,
       c_mktsegment AS STATUS,
       'In<br>' || c_mktsegment || '<br>' AS STATUSSHOWNTOCLIENT,
       'X' || CAST(c_custkey AS STRING) AS EXTERNALREFERENCE,
       CAST(c_custkey * 2 AS STRING) AS EXTERNALJOBNUMBER,
       CAST(c_custkey * 3 AS STRING) AS EXTERNALJOBNUMBER2,
       CAST(c_custkey * 5 AS STRING) AS MINENUMBER,
       first_order AS CREATEDDATE,
       CASE WHEN c_custkey % 2 = 0 THEN first_order + INTERVAL 36 HOUR END AS SUBMITTEDDATE,
       CASE WHEN c_custkey % 3 = 0 THEN first_order + INTERVAL 90 SECOND END AS RECEIVEDDATE,
       CASE WHEN c_custkey % 5 = 0 THEN last_order END AS DATECOMPLETED
FROM {customer}
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
           FROM {orders} GROUP BY o_custkey) dated ON o_custkey = c_custkey"""

LINKS = """
SELECT o_custkey AS ATSLINKID,
       o_orderkey AS ATSAUTHORIZATIONNUMBER,
       o_orderkey + 7 AS LANDSFILENUMBER,
       o_orderkey AS DISPOSITION_TRANSACTION_SID,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN 'n/a'
            WHEN o_orderkey % 8 = 2 THEN CAST(o_orderkey AS STRING) || '.0'
            ELSE ' ' || CAST(o_orderkey AS STRING) || ' ' END AS DISPOSITION_TRANSACTION_STRING
FROM {orders}"""

AREAS = """
SELECT l_orderkey AS ATSAUTHORIZATIONNUMBER,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE ' ' || CAST(l_orderkey AS STRING) || '.0' END AS BUSINESSAREANUMBER
FROM {lineitem}"""

AUTHORIZATIONS = """
SELECT CAST(o_orderkey * 2 AS DECIMAL(38,18)) AS AUTHORIZATION_ID,
       o_custkey AS PROJECT_ID,
       'F' || CAST(o_orderkey AS STRING) AS FILE_NUMBER,
       o_orderstatus AS AUTHORIZATION_STATUS_CODE,
       CAST(o_custkey % 7 AS STRING) AS ATHN_CLOSE_REASON_CODE,
       o_orderdate AS APPLICATION_RECEIVED_DATE,
       o_orderdate + INTERVAL 1 DAY AS APPLICATION_ACCEPTED_DATE,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 2 DAY END AS APPLICATION_REJECTED_DATE,
       o_orderdate + INTERVAL 3 DAY AS FIRST_NATION_START_DATE,
       o_orderdate + INTERVAL 4 DAY AS FIRST_NATION_COMPLETION_DATE,
       o_orderdate + INTERVAL 5 DAY AS TECH_REVIEW_COMPLETION_DATE,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 6 DAY END AS ADJUDICATION_DATE,
       o_orderdate + INTERVAL 7 DAY AS AUTHORIZATION_DUE_DATE,
       o_orderdate + INTERVAL 8 DAY AS FCBC_PROCESS_COMPLETE_DATE,
       o_orderdate - INTERVAL 1 DAY AS WHEN_CREATED,
       o_orderdate + INTERVAL 9 DAY AS WHEN_UPDATED,
       o_orderkey % 100 AS APPLICATION_FEE,
       o_orderkey % 200 AS AUTHORIZATION_FEE
FROM {orders}"""

CLOSE_REASONS = "SELECT CAST(r_regionkey AS STRING) AS ATHN_CLOSE_REASON_CODE, 'Closed: ' || r_name AS DESCRIPTION FROM {region}"
AUTH_STATUSES = "SELECT DISTINCT replace(o_orderstatus, 'P', '-') AS AUTHORIZATION_STATUS_CODE, 'Auth ' || o_orderstatus AS DESCRIPTION FROM {orders}"

WATER_JOBS = """
SELECT CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN ' ' ELSE 'J' || CAST(o_orderkey AS STRING) END AS JobNumber,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'T' || CAST(o_custkey AS STRING) || ' ' END AS VfcTrackingNumber,
       CASE WHEN o_orderkey % 5 = 0 THEN o_custkey END AS AtsLinkId,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS DECIMAL(38,18)) END AS AuthorizationId,
       o_orderdate AS ReceivedDate,
       CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 11 DAY END AS FcbcAcceptedDate,
       o_orderdate + INTERVAL 12 DAY AS FcbcCompleteDate,
       CASE WHEN o_orderkey % 7 = 1 THEN o_orderdate + INTERVAL 13 DAY END AS GrantedRefuseDate,
       CASE o_orderkey % 3 WHEN 0 THEN '10:30' WHEN 1 THEN ' ' ELSE 'CA' END AS Code_Chr_Status
FROM {orders}"""

ATTEMPTS = """
SELECT CAST(user_id AS STRING) || '-' || event_type AS record_id,
       user_id AS line_no,
       CAST(event_id % 4 + 1 AS INT) AS attempt,
       CASE CAST(floor(value) AS INT) % 9
            WHEN 0 THEN 503 WHEN 1 THEN 401 WHEN 2 THEN 429 WHEN 3 THEN NULL WHEN 4 THEN 200
            WHEN 5 THEN 403 WHEN 6 THEN 500 WHEN 7 THEN 400 ELSE 201 END AS status,
       event_type AS error
FROM {events}"""
